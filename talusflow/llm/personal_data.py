"""Personal data: fixed patterns, and contexts learnt from them (DataFrame functions only)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from talusflow.llm.common import settled, written
from talusflow.operators.reduction import key_bits, likely_keys

# The base patterns by kind. Each is the contract's, written so that a failing start
# is given up at once: `\G` or the look-behind admits only the first place of a run of characters,
# from which every later place of the run would fail as well, and `++` gives nothing back.
_LOCAL = "A-Za-z0-9._%+-"
PATTERNS = {
    "email": rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?+[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# A text without a match of this has none of the pattern above, and is left out cheaply.
_NEEDS = {"email": "@", "ip": "[0-9]\\.[0-9]", "card": "[0-9][\\x20-]?[0-9]", "phone": "\\+[0-9]"}
KINDS = (*PATTERNS, "id")

_SPACE = r"[\x20\x09-\x0D]+"
_OPENING = r"(?<![^\x20\x09-\x0D])[^\p{L}\p{N}+\x20\x09-\x0D]+$"
_CLOSING = r"^[^\x20\x09-\x0D]+"  # what still clings to the span
_EDGES = r"^[^\p{L}\p{N}+]+|[^\p{L}\p{N}]+$"
_HIT = "array<struct<start:int,hit:string>>"
_SPAN = "array<struct<start:int,rank:int,end:int>>"


def located(text: Column, pattern: str, valid: Callable[[Column], Column]) -> Column:
    """All valid matches in order: start (code points from 0) and the match.

    The pieces between matches and the matches have the lengths that add up to each start.
    """
    pairs = F.zip_with(F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)),
                       lambda gap, hit: F.struct(gap.alias("gap"), hit.alias("hit")))
    start = F.struct(F.lit(0).alias("at"), F.array().cast(_HIT).alias("found"))
    folded = F.aggregate(
        F.filter(pairs, lambda p: p["hit"].isNotNull()), start,
        lambda acc, p: F.struct(
            (acc["at"] + F.length(p["gap"]) + F.length(p["hit"])).alias("at"),
            F.when(valid(p["hit"]), F.concat(acc["found"], F.array(F.struct(
                (acc["at"] + F.length(p["gap"])).alias("start"), p["hit"].alias("hit")))))
            .otherwise(acc["found"]).alias("found")))
    return folded["found"]


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _valid(kind: str, hit: Column) -> Column:
    if kind == "ip":
        parts = F.transform(F.split(hit, r"\."), lambda p: F.regexp_replace(p, "^0+(?=.)", ""))
        return F.forall(parts, lambda p: (F.length(p) <= 3) & (F.left(p, F.lit(3)).cast("int") <= 255))
    if kind == "card":
        return F.length(_digits(hit)).between(14, 19) & F.call_function("luhn_check", _digits(hit))
    if kind == "phone":
        return F.length(_digits(hit)).between(10, 15)
    return F.lit(True)


def _base_spans(text: Column, kind: str) -> Column:
    spans = F.transform(located(text, PATTERNS[kind], lambda hit: _valid(kind, hit)), lambda h: F.struct(
        h["start"].alias("start"), F.lit(KINDS.index(kind)).alias("rank"),
        (h["start"] + F.length(h["hit"])).alias("end")))
    return F.when(F.coalesce(text.rlike(_NEEDS[kind]), F.lit(False)), spans).otherwise(
        F.array().cast(_SPAN))


def _shape(token: Column) -> Column:
    """Runs of digits as 9, runs of letters as a: what a token looks like."""
    return F.regexp_replace(F.regexp_replace(token, r"\p{L}+", "a"), "[0-9]+", "9")


def _words(text: Column) -> Column:
    return F.array_remove(F.split(text, _SPACE), "")


def _patterns(two: Column, near: Column, token: Column, after: Column) -> Column:
    """What surrounds a token: the word before and the token's shape, two words before and its shape,
    two words before, and the words on both sides."""
    shape = _shape(token)
    return F.filter(F.array(
        F.concat(F.lit("1 "), near, F.lit(" "), shape), F.concat(F.lit("2 "), two, F.lit(" "), near, F.lit(" "), shape),
        F.when(two != "", F.concat(F.lit("3 "), two, F.lit(" "), near)),
        F.when((near != "") & (after != ""), F.concat(F.lit("4 "), near, F.lit(" "), after))), lambda p: p.isNotNull())


def _let(value: Column, then: Callable[[Column], Column]) -> Column:
    """`then` of a value that is computed once, however often `then` names it."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def _piece(wide: Column, start: Column, length: Column) -> Column:
    """Code points of a text in UTF-32, found without counting through the text before them."""
    return F.decode(F.substring(wide, start * 4 + 1, length * 4), "UTF-32")


def _disjoint(spans: Column) -> Column:
    """Sorted spans, those that overlap as one, with the rank of the first: start, rank, end."""
    none = F.array().cast(_SPAN)
    last = lambda done: F.get(done, F.size(done) - 1)
    return F.aggregate(spans, none, lambda done, s: F.when(
        (F.size(done) > 0) & (s["start"] < last(done)["end"]),
        F.concat(F.slice(done, 1, F.size(done) - 1), F.array(F.struct(
            last(done)["start"].alias("start"), last(done)["rank"].alias("rank"),
            F.greatest(last(done)["end"], s["end"]).alias("end"))))).otherwise(F.concat(done, F.array(s))))


def _replaced(text: Column, spans: Column, by: Callable[[Column, Column], Column]) -> Column:
    """The text with `by(text in UTF-32, span)` in place of each run of spans."""
    def build(known: Column) -> Column:
        wide, runs = known["wide"], known["runs"]
        before = lambda i: F.coalesce(F.get(runs, i - 1)["end"], F.lit(0))
        pieces = F.transform(runs, lambda s, i: F.concat(
            _piece(wide, before(i), s["start"] - before(i)), by(wide, s)))
        end = F.get(runs, F.size(runs) - 1)["end"]
        rest = F.decode(F.substring(wide, end * 4 + 1, F.octet_length(wide)), "UTF-32")
        return F.concat(F.array_join(pieces, ""), rest)

    done = _let(F.struct(F.encode(text, "UTF-32").alias("wide"), _disjoint(spans).alias("runs")), build)
    return F.when(F.size(spans) > 0, done).otherwise(text)


def _blanked(text: Column, spans: Column) -> Column:
    """The text with another character in place of each one of the spans; white space stays."""
    return _replaced(text, spans, lambda wide, s: F.regexp_replace(
        _piece(wide, s["start"], s["end"] - s["start"]), r"[^\x20\x09-\x0D]", "\uE000"))


_CONTEXT = 256  # code points on each side of a span in which its neighbouring words are sought


def _instances(rows: DataFrame) -> DataFrame:
    """pattern, near, token of every base span, whatever it is made of; tokens and words in lower case.

    A cut-off piece of a word at the far end of the context counts as a word.
    """
    def around(known: Column) -> Column:
        wide = known["wide"]
        return F.transform(known["base"], lambda s: F.struct(
            F.lower(_piece(wide, s["start"], s["end"] - s["start"])).alias("token"),
            _piece(wide, F.greatest(s["start"] - _CONTEXT, F.lit(0)), F.least(s["start"], F.lit(_CONTEXT))).alias("_before"),
            _piece(wide, s["end"], F.lit(_CONTEXT)).alias("_behind")))

    wide = F.struct(F.encode("_text", "UTF-32").alias("wide"), F.col("base").alias("base"))
    spans = rows.where(F.size("base") > 0).select(F.inline(_let(wide, around)))
    said = spans.select("token", _words(F.lower(F.regexp_replace("_before", _OPENING, ""))).alias("_w"),
                        _words(F.lower(F.regexp_replace("_behind", _CLOSING, ""))).alias("_v"))
    last = lambda n: F.coalesce(F.get("_w", F.size("_w") - n), F.lit(""))
    return said.select("token", last(1).alias("near"), F.explode(
        _patterns(last(2), last(1), F.col("token"), F.coalesce(F.get("_v", F.lit(0)), F.lit("")))).alias("pattern"))


def _places(rows: DataFrame) -> DataFrame:
    """Every word outside the base spans, in lower case: _row, _at (its number), word, near, two, after."""
    low = _words(F.lower(F.col("_text")))
    outside = F.when(F.size("base") > 0, _words(F.lower(_blanked(F.col("_text"), F.col("base")))))
    words = rows.select("_row", low.alias("_w"), outside.alias("_b")).select(
        "_row", F.arrays_zip(
            "_w", F.coalesce("_b", "_w").alias("_b"), F.concat(F.array(F.lit("")), "_w").alias("_n"),
            F.concat(F.array(F.lit(""), F.lit("")), "_w").alias("_t"),
            F.slice("_w", 2, F.greatest(F.size("_w"), F.lit(1))).alias("_a")).alias("_z"))
    z = F.col("_z")
    return words.select("_row", F.posexplode("_z").alias("_at", "_z")).where(z["_w"] == z["_b"]).select(
        "_row", "_at", z["_w"].alias("word"), z["_n"].alias("near"), z["_t"].alias("two"),
        F.coalesce(z["_a"], F.lit("")).alias("after"))


def _trimmed(word: Column) -> Column:
    """The word without what clings to its ends; most words begin and end plainly and need no search."""
    def plain(c: Column) -> Column:
        return c.between("a", "z") | c.between("0", "9")
    ends = plain(F.left(word, F.lit(1))) & plain(F.right(word, F.lit(1)))
    return F.when(ends, word).otherwise(F.regexp_replace(word, _EDGES, ""))


def _with_patterns(places: DataFrame, *more: str) -> DataFrame:
    return places.where("token <> ''").select(*more, "near", "token", F.explode(
        _patterns(F.col("two"), F.col("near"), F.col("token"), F.col("after"))).alias("pattern"))


def learn_patterns(edges: DataFrame, min_hits: float = 5, min_share: float = 0.8) -> tuple[DataFrame, DataFrame]:
    """Patterns that lead to known identifiers with high confidence, and the belief in other tokens.

    `edges` has pattern, token, seed (1.0 or 0.0), one row for each pair. In each round a pattern's
    share is the mean belief in its tokens, and a token without a seed gets the best share of its
    confident patterns, lessened a little. A pattern is confident with at least `min_hits` believed
    tokens and a share of at least `min_share`. Belief never falls, so the confident patterns only
    become more; the rounds end when they stop doing so. A pattern's tokens are counted once; a
    round adds up only what is newly believed.
    """
    counted = written(edges.groupBy("pattern").agg(F.count(F.lit(1)).alias("n"), F.sum("seed").alias("known")), "pii-counted")
    unsure = written(edges.where("seed < 1").select("pattern", "token"), "pii-unsure", "zstd")
    gained, before = None, -1
    while True:
        hits = counted.withColumn("hits", F.col("known")) if gained is None else counted.join(
            gained, "pattern", "left").withColumn("hits", F.col("known") + F.coalesce("gain", F.lit(0.0)))
        good = written(hits.withColumn("share", F.col("hits") / F.col("n")).where(
            (F.col("hits") >= min_hits) & (F.col("share") >= min_share)).select("pattern", "share", "hits"), "pii-patterns")
        told = written(unsure.join(good.select("pattern", "share"), "pattern").groupBy("token").agg(
            (F.max("share") * 0.9).alias("told")), "pii-told")
        if (now := good.count()) == before or not now:
            return good, told
        gained = written(unsure.join(told, "token").groupBy("pattern").agg(F.sum("told").alias("gain")), "pii-gained")
        before = now


def _hits(edges: DataFrame, told: DataFrame) -> DataFrame:
    """pattern, near, hits: the belief in each pattern's tokens, added up."""
    known = edges.groupBy("pattern").agg(F.sum("seed").alias("known"), F.min("near").alias("near"))
    gain = edges.where("seed < 1").select("pattern", "token").join(told, "token").groupBy("pattern").agg(
        F.sum("told").alias("gain"))
    return known.join(gain, "pattern", "left").select(
        "pattern", "near", (F.col("known") + F.coalesce("gain", F.lit(0.0))).alias("hits"))


def _learnt(rows: DataFrame, min_hits: int = 5, min_share: float = 0.8, min_support: float = 0.002) -> DataFrame:
    """_row and _at of the tokens outside base spans that confident patterns lead to.

    Starts from the patterns of the base spans. Only a pattern that leads to enough believed tokens
    (`min_hits`, and `min_support` of all different base tokens, so that chance contexts do not become
    patterns as the corpus grows) can be confident, so the texts are read for all tokens of just these;
    then for all patterns of the tokens that are believed now, and so on until no further pattern has enough.
    """
    named = edges = written(_instances(rows).distinct().withColumn("seed", F.lit(1.0)), "pii-edges", "zstd")
    least = max(float(min_hits), min_support * named.select("token").distinct().count())
    none = named.where(F.lit(False))
    places = none.select(F.lit(0).cast("long").alias("_row"), F.lit(0).alias("_at"), "pattern", "near", "token")
    looked, good, asked = none.select("pattern", "near"), none.select("pattern"), none.select("token")
    told = none.select("token", F.col("seed").alias("told"))
    while True:
        able = written(_hits(edges, told).where(F.col("hits") >= least).select("pattern", "near")
                       .join(looked, "pattern", "left_anti"), "pii-able")
        if able.isEmpty():
            break
        nears = written(able.select("near").distinct(), "pii-nears")
        found = _with_patterns(_places(rows).join(nears, "near", "left_semi").withColumn(
            "token", _trimmed(F.col("word"))), "_row", "_at")
        places = places.unionByName(written(found.join(able.select("pattern"), "pattern", "left_semi"), "pii-places", "zstd"))
        looked = looked.unionByName(able)
        edges = written(edges.unionByName(places.select("pattern", "near", "token").distinct().withColumn("seed", F.lit(0.0)))
                        .groupBy("pattern", "near", "token").agg(F.max("seed").alias("seed")), "pii-edges", "zstd")
        good, told = learn_patterns(edges.join(looked.select("pattern"), "pattern", "left_semi")
                                    .select("pattern", "token", "seed"), least, min_share)
        # A base token's own occurrences are all in `named`; of others the patterns are read now.
        fresh = written(told.select("token").join(named.select("token").distinct(), "token", "left_anti")
                        .join(asked, "token", "left_anti"), "pii-fresh")
        if not fresh.isEmpty():
            asked = asked.unionByName(fresh)
            more = _with_patterns(_places(rows).withColumn("token", _trimmed(F.col("word"))).join(
                fresh, "token", "left_semi"))
            edges = written(edges.unionByName(more.distinct().withColumn("seed", F.lit(0.0)))
                            .groupBy("pattern", "near", "token").agg(F.max("seed").alias("seed")), "pii-edges", "zstd")
    return written(places.join(good.select("pattern"), "pattern", "left_semi").select("_row", "_at").distinct(),
                   "pii-learnt")


def _word_spans(rows: DataFrame, learnt: DataFrame) -> DataFrame:
    """_row and `_more`, the trimmed spans of the words numbered `_at` (from 0), in any order.

    Each text with such words is cut once; running sums over its words and gaps give the places. The
    other texts are left out by hashed bits of the row numbers, before anything is shuffled.
    """
    few = likely_keys(rows.select("_row", "_text"), "_row", key_bits(learnt, "_row"))
    texts = few.join(learnt.select("_row").distinct(), "_row", "left_semi")
    # Gaps and words take turns, beginning with the gap before the first word.
    parts = texts.select("_row", F.posexplode(F.arrays_zip(
        F.split("_text", r"[^\x20\x09-\x0D]+", -1).alias("gap"), _words(F.col("_text")).alias("word"))).alias("_at", "_p")).select(
        "_row", "_at", F.length("_p.gap").alias("_gap"), F.col("_p.word").alias("_word"))
    before = Window.partitionBy("_row").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    length = F.coalesce(F.length("_word"), F.lit(0))
    placed = parts.withColumn("_start", F.coalesce(F.sum(F.col("_gap") + length).over(before), F.lit(0)) + F.col("_gap"))
    found = placed.join(learnt, ["_row", "_at"])
    start = (F.col("_start") + F.length(F.regexp_extract("_word", r"^[^\p{L}\p{N}+]*", 0))).cast("int")
    span = F.struct(start.alias("start"), F.lit(KINDS.index("id")).alias("rank"),
                    (start + F.length(F.regexp_replace("_word", _EDGES, ""))).alias("end"))
    return found.groupBy("_row").agg(F.collect_set(span).alias("_more"))


def find_personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       keep: tuple[str, ...] = (), **learning: float) -> DataFrame:
    """Spans of personal data of every document: doc_id, base and all, with the columns in `keep`.

    `base` and `all` are arrays of (start, rank, end) in order; rank is the place in KINDS. Base
    spans come from the fixed patterns, each kind on its own, and all of them teach contexts; any
    word that lies in no base span, with or without digits, is added as `id` when a confident
    context leads to it. An `id` is one word; what is written in several is found word by word. Null
    and empty texts have no spans; repeated rows and null ids keep their rows; an empty table gives
    none.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    row = docs.select(F.col(id_col).alias("doc_id"), *[F.col(c) for c in keep], text.alias("_text"))
    for kind in PATTERNS:
        row = row.withColumn(f"_{kind}", _base_spans(F.col("_text"), kind))
    base = F.array_sort(F.concat(*[F.col(f"_{k}") for k in PATTERNS]))
    kept = [c for c in keep if c != text_col]
    own = [F.col("_text")] if text_col not in keep else [F.col(text_col)]
    row = row.select("doc_id", *kept, *own, base.alias("base"), F.monotonically_increasing_id().alias("_row"))
    row = written(row, "pii-spans", "zstd")
    if text_col in keep:
        row = row.withColumn("_text", F.coalesce(F.col(text_col), F.lit("")))
    rows = row.select("_row", "_text", "base")
    spans = settled(docs.sparkSession, "pii-found", lambda: _word_spans(rows, _learnt(rows, **learning)))
    return row.join(spans, "_row", "left").select(
        "doc_id", *keep, "base",
        F.array_sort(F.concat("base", F.coalesce("_more", F.array().cast(_SPAN)))).alias("all"))


def spans_text(spans: Column) -> Column:
    """kind:start:end of each span, joined by commas."""
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(kinds, s["rank"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def masked(text: Column, spans: Column) -> Column:
    """The text with each span replaced by its kind in brackets; overlapping spans share one."""
    kinds = F.array(*[F.lit(f"[{k}]") for k in KINDS])
    return _replaced(text, spans, lambda _, s: F.get(kinds, s["rank"]))
