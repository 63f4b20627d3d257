"""Ground-hazard analytics as Spark jobs: catalogue, weather warehouse, features, models, streams."""

__version__ = "0.1.0"
