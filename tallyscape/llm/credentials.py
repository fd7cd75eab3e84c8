"""Secret scan with linking of multipart credentials, in SQL functions alone.

Strong spans are reported as they are.  Weak candidates (bare keys, endpoints) say little by
themselves; one is reported only where a complementary part lies within the same scope.  Parts
and scopes are joined as intervals: one sweep over a document's parts in order of position and
one against it, so the work follows the number of parts.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyscape.llm.common import whole

_NAMES = ("password", "passwd", "secret", "token")


def _either_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" for c in word)


#: Strong kinds in the order that breaks ties, then weak ones.
ASSIGN = (
    "(" + "|".join([*map(_either_case, _NAMES), _either_case("api") + "_?" + _either_case("key")]) + ")"
    + r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = "AKIA[A-Z0-9]+"
HEX = "[0-9a-f]{32,}"
ENDPOINT = r"(?:https?|wss?|s3|postgresql|mysql|mongodb|redis|amqp)://[A-Za-z0-9._~:/?#@!$&*+,;=%-]+"
BARE = "[A-Za-z0-9+/]{40,}"
KINDS = ("assign", "access", "hex", "endpoint", "bare")
#: Complementary parts of each weak kind.
COMPLEMENTS = {"endpoint": ("assign", "access"), "bare": ("access", "endpoint")}
SCOPE = 400  # code points between two parts of one credential

_SPAN = "array<struct<start:int,rank:int,end:int>>"
CHUNK = 256  # elements that a sweep puts together at a time


def _sweep(items: Column, state: Column, kind: str, step: Callable[[Column, Column], tuple[Column, Column]]) -> Column:
    """One array from all that ``step`` gives for (state, item), which also hands on the state.

    Appending copies an array, so results are gathered by chunks, then the chunks: near linear for any length.
    """
    none, nothing = F.expr(f"cast(array() as {kind})"), F.expr(f"cast(array() as array<{kind}>)")

    def one(done: Column, item: Column) -> Column:
        after, made = step(done["state"], item)
        return F.struct(after.alias("state"), F.concat(done["out"], made).alias("out"))

    def some(done: Column, part: Column) -> Column:
        begin = F.struct(done["state"].alias("state"), none.alias("out"))
        joined = lambda end: F.struct(end["state"].alias("state"), F.concat(done["out"], F.array(end["out"])).alias("out"))
        return F.aggregate(part, begin, one, joined)

    def swept(held: Column) -> Column:  # ``held`` is bound once, not computed anew for each chunk
        starts = F.sequence(F.lit(1), F.greatest(F.size(held), F.lit(1)), F.lit(CHUNK))
        chunks = F.transform(starts, lambda i: F.slice(held, i, CHUNK))
        begin = F.struct(state.alias("state"), nothing.alias("out"))
        return F.aggregate(chunks, begin, some, lambda end: F.flatten(end["out"]))

    return F.get(F.transform(F.array(items), swept), F.lit(0))


def _found(text: Column, pattern: str, rank: int, passing=None) -> Column:
    """Spans of the leftmost non-overlapping matches, in code points.

    The pieces between the matches and the matches alternate, so their lengths give positions.
    """
    gaps = F.split(text, pattern, -1)
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    zipped = F.arrays_zip(gaps.alias("gap"), hits.alias("hit"))
    if passing is None:
        passing = lambda hit: F.lit(True)

    def step(at: Column, x: Column) -> tuple[Column, Column]:
        start = at + F.length(x["gap"])
        end = start + F.coalesce(F.length(x["hit"]), F.lit(0))
        span = F.struct(start.alias("start"), F.lit(rank).alias("rank"), end.alias("end"))
        more = F.when(x["hit"].isNotNull() & passing(x["hit"]), F.array(span)).otherwise(F.expr(f"cast(array() as {_SPAN})"))
        return end, more

    spans = _sweep(zipped, F.lit(0), _SPAN, step)
    # Most texts hold nothing of a kind; they are searched once.
    return F.when(F.regexp_like(text, F.lit(pattern)), spans).otherwise(F.expr(f"cast(array() as {_SPAN})"))


def _near(parts: Column, scope: int) -> Column:
    """For each part of a sorted array, whether an earlier one of each kind reaches to ``scope`` before it, or beyond."""
    ends = ", ".join(f"'e{k}', cast(null as int)" for k in range(len(KINDS)))
    kind = "array<struct<part:struct<start:int,rank:int,end:int>,near:array<boolean>>>"

    def step(done: Column, x: Column) -> tuple[Column, Column]:
        near = F.array(*[F.coalesce(x["start"] - done[f"e{k}"] <= scope, F.lit(False)) for k in range(len(KINDS))])
        item = F.struct(x.alias("part"), near.alias("near"))
        reach = [
            F.when(x["rank"] == k, F.greatest(done[f"e{k}"], x["end"])).otherwise(done[f"e{k}"]).alias(f"e{k}")
            for k in range(len(KINDS))
        ]
        return F.struct(*reach), F.array(item)

    return _sweep(parts, F.expr(f"named_struct({ends})"), kind, step)


def _listed(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    one = lambda s: F.concat_ws(":", F.get(names, s["rank"]), s["start"], s["end"])
    return F.array_join(F.transform(spans, one), ",")


def scan(docs: DataFrame, text: str = "text", *, scope: int = SCOPE) -> DataFrame:
    """Adds ``base`` and ``spans``: arrays of (start, rank, end) by start, then kind.

    ``base`` has the strong spans (assign, access, hex), ``spans`` also the weak ones that a
    complementary part stands by: an endpoint by an assign or access span, a bare key by an access or
    endpoint span, with at most ``scope`` code points between them, or one within the other.  Null and empty texts have none.
    One row in, one row out; no shuffle.
    """
    t = whole(text)
    group = lambda hit: F.length(F.regexp_extract(hit, ASSIGN, 2)) >= 8
    parts = docs.withColumn(
        "_parts",
        F.array_sort(
            F.concat(
                _found(t, ASSIGN, 0, group),
                _found(t, ACCESS, 1, lambda hit: F.length(hit) >= 16),
                _found(t, HEX, 2),
                _found(t, ENDPOINT, 3),
                _found(t, BARE, 4),
            )
        ),
    )
    # Mirrored, what follows a part comes before it.  The order stays that of the starts, turned round: what starts
    # after a part comes before it, also if it ends within it.
    flip = lambda s: F.struct((-s["end"]).alias("start"), s["rank"].alias("rank"), (-s["start"]).alias("end"))
    none = F.expr("cast(array() as array<struct<part:struct<start:int,rank:int,end:int>,near:array<boolean>>>)")
    some = F.exists("_parts", lambda s: s["rank"] >= 3)
    swept = parts.withColumn("_ahead", F.when(some, _near(F.col("_parts"), scope)).otherwise(none)).withColumn(
        "_back",
        F.when(some, _near(F.transform(F.reverse("_parts"), flip), scope)).otherwise(none),
    )

    def linked(x: Column) -> Column:
        met = F.lit(False)
        for weak, others in COMPLEMENTS.items():
            by = F.lit(False)
            for other in others:
                by = by | F.get(x["near"], F.lit(KINDS.index(other)))
            met = met | ((x["part"]["rank"] == KINDS.index(weak)) & by)
        return met

    ahead = F.transform(F.filter("_ahead", linked), lambda x: x["part"])
    back = F.transform(F.filter("_back", linked), lambda x: flip(x["part"]))
    strong = F.filter("_parts", lambda s: s["rank"] < 3)
    spans = F.array_sort(F.concat(strong, F.array_union(ahead, back)))
    return swept.withColumns({"base": strong, "spans": spans}).drop("_parts", "_ahead", "_back")


def report(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", *, scope: int = SCOPE) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans as text."""
    found = scan(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), scope=scope)
    count = lambda k: F.size(F.filter("base", lambda s: s["rank"] == k)).cast("long")
    return found.select(
        "doc_id",
        count(0).alias("n_assign"),
        count(1).alias("n_access"),
        count(2).alias("n_hex"),
        F.sha2(_listed(F.col("base")), 256).alias("base_sha256"),
        _listed(F.col("spans")).alias("spans"),
    )
