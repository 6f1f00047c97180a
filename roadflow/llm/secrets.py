"""Secret scan with DataFrame functions only: patterns, and sliding-window entropy of candidate strings."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import fresh, without

#: The base patterns, in the order of their kinds.
ASSIGN = r"""(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
KINDS = ("assign", "access", "hex", "entropy")
#: Candidate strings, window length, and the least entropy in bits that a window of each class must reach.
CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"
WINDOW = 20
LEAST_BITS = {"hex": 3.0, "upper": 3.4, "mixed": 3.7}
#: Candidates that are known not to be secrets.
ALLOWED = r"^[0-9]+$|^[A-Za-z]+$|^[/_=+-]+$|^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$|(?i)example|placeholder|changeme|x{6}|0123456789|abcdefgh"
#: The parts that ALLOWED knows anywhere in a candidate, and their lengths: they cut it, and what is left is judged.
ALLOWED_PARTS = {"(?i)example": 7, "(?i)placeholder": 11, "(?i)changeme": 8, "(?i)x{6}": 6, "0123456789": 10, "(?i)abcdefgh": 8}
SCALE = 1_000_000
#: c * log2(c) in millionths, for c = 0 to WINDOW: whole numbers, so that sums don't depend on their order.
COUNT_BITS = [0, *[round(c * math.log2(c) * SCALE) for c in range(1, WINDOW + 1)]]

#: Items that are added up before their chunk is closed; the mark that a UTF-32 decoder takes off the front.
CHUNK, BYTE_ORDER = 256, bytearray(b"\x00\x00\xfe\xff")


def most_allowed(bits: float) -> int:
    """The sum of c * log2(c) at which a window's entropy is just ``bits``."""
    return math.floor((math.log2(WINDOW) - bits) * WINDOW * SCALE)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once: inside a function of an array's items it would be computed for each."""
    return F.element_at(F.transform(F.array(value), body), 1)


def running(values: Column, step: Callable[[Column, Column], Column]) -> Column:
    """Running sums or maxima (by ``step``) of whole numbers from 0 on, the 0 first: one more than ``values`` has.

    Arrays are copied when they grow, so the items are added up in chunks, and the chunks' ends in a second level: the
    cost is near to the number of items even of texts with hundreds of thousands of matches."""
    grow = lambda acc, x: F.array_append(acc, step(F.element_at(acc, -1), x))
    zero = F.array(F.lit(0))
    starts_of = lambda v: F.sequence(F.lit(1), F.greatest(F.size(v), F.lit(1)), F.lit(CHUNK))

    def joined(chunks: Column) -> Column:
        ends = F.aggregate(chunks, zero, lambda acc, c: grow(acc, F.element_at(c, -1)))
        parts = F.zip_with(chunks, F.slice(ends, 1, F.size(chunks)), lambda c, base: F.transform(F.slice(c, 2, CHUNK), lambda x: step(base, x)))
        return F.concat(zero, F.flatten(parts))

    return let(values, lambda v: let(F.transform(starts_of(v), lambda i: F.aggregate(F.slice(v, i, CHUNK), zero, grow)), joined))


def spans_of(text: Column, pattern: str) -> Column:
    """Array of (start, end, text) of all matches, in code points: lengths of matches and of what stands between."""
    gaps = F.split(text, pattern, -1)
    lengths = lambda found: F.zip_with(F.slice(gaps, 1, F.size(found)), found, lambda g, m: F.length(g) + F.length(m))
    spans = let(
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)),
        lambda found: F.zip_with(
            F.slice(running(lengths(found), lambda x, y: x + y), 2, F.size(found)), found,
            lambda e, m: F.struct((e - F.length(m)).alias("s"), e.alias("e"), m.alias("m")),
        ),
    )
    return F.when(text.rlike(pattern), spans).otherwise(F.array().cast("array<struct<s:int,e:int,m:string>>"))


def least_window(text: Column) -> Column:
    """Smallest sum of c * log2(c) over the windows of a string: one pass, where each step adds the character that
    enters and takes away the one that leaves. Small sums are windows of high entropy."""
    table = F.array(*[F.lit(v) for v in COUNT_BITS])

    def least(chars: Column, letters: Column) -> Column:
        def step(acc: Column, i: Column) -> Column:
            enters = F.array_position(letters, F.element_at(chars, i)).cast("int")
            leaves = F.when(i > WINDOW, F.array_position(letters, F.element_at(chars, F.greatest(i - WINDOW, F.lit(1)))).cast("int")).otherwise(F.lit(0))
            was_in = F.element_at(acc["n"], enters)
            was_out = F.when(leaves > 0, F.element_at(acc["n"], F.greatest(leaves, F.lit(1)))).otherwise(F.lit(0))
            change = F.when(enters == leaves, F.lit(0)).otherwise(
                F.element_at(table, was_in + 2) - F.element_at(table, was_in + 1)
                + F.when(leaves > 0, F.element_at(table, was_out) - F.element_at(table, was_out + 1)).otherwise(F.lit(0))
            )
            total = acc["sum"] + change
            return F.struct(
                F.transform(
                    acc["n"],
                    lambda n, j: n
                    + F.when(j + 1 == enters, 1).otherwise(0)
                    - F.when(j + 1 == leaves, 1).otherwise(0),
                ).alias("n"),
                total.cast("int").alias("sum"),
                F.when(i >= WINDOW, F.least(acc["least"], total)).otherwise(acc["least"]).cast("int").alias("least"),
            )

        start = F.struct(
            F.array_repeat(F.lit(0), F.size(letters)).alias("n"), F.lit(0).alias("sum"), F.lit(2**31 - 1).alias("least")
        )
        return F.aggregate(F.sequence(F.lit(1), F.size(chars)), start, step, lambda acc: acc["least"])

    return let(F.split(text, ""), lambda chars: let(F.array_distinct(chars), lambda letters: least(chars, letters)))


def is_secret(candidate: Column) -> Column:
    """Some window of the candidate has at least the entropy of the candidate's class, and it isn't allow-listed."""
    limit = (
        F.when(candidate.rlike("^[0-9a-f]+$|^[0-9A-F]+$"), most_allowed(LEAST_BITS["hex"]))
        .when(candidate.rlike("^[0-9A-Z+/_=-]+$|^[0-9a-z+/_=-]+$"), most_allowed(LEAST_BITS["upper"]))
        .otherwise(most_allowed(LEAST_BITS["mixed"]))
    )
    return candidate.rlike("[0-9]") & ~candidate.rlike(ALLOWED) & (least_window(candidate) <= limit)


def rebuilt(text: Column, spans: Column, put: Callable[[Column, Column, Column], Column]) -> Column:
    """The text with ``put(before, start, end)`` for each span, ordered by start (``before``: the furthest end of earlier
    spans); what lies between spans is kept. It is cut from code points of four bytes, where any place is found at once."""

    def build(codes: Column, ends: Column) -> Column:
        def between(start: Column, end: Column) -> Column:
            part = F.substring(codes, start * 4 + 1, F.greatest(end - start, F.lit(0)) * 4)
            return F.decode(F.concat(F.lit(BYTE_ORDER), part), "UTF-32")

        parts = F.zip_with(F.slice(ends, 1, F.size(spans)), spans, lambda at, x: F.concat(between(at, x["s"]), put(at, x["s"], x["e"])))
        last = F.element_at(ends, -1)
        return F.concat(F.array_join(parts, ""), between(last, F.length(text)))

    furthest = running(F.transform(spans, lambda x: x["e"]), F.greatest)
    whole = let(F.encode(text, "UTF-32"), lambda codes: let(furthest, lambda ends: build(codes, ends)))
    return F.when(F.size(spans) > 0, whole).otherwise(text)


def blanked(text: Column, spans: Column) -> Column:
    """The text with spaces of the same length where the spans (ordered by start) and the allow-listed parts stand."""
    out = rebuilt(text, spans, lambda at, s, e: F.repeat(F.lit(" "), F.greatest(e - F.greatest(s, at), F.lit(0))))
    for part, n in ALLOWED_PARTS.items():
        out = F.regexp_replace(out, part, " " * n)
    return out


def scan_secrets(docs: DataFrame, text_col: str = "text", into: str = "secret_spans") -> DataFrame:
    """The documents with ``into``: array of (s, e, k, m), code points, end exclusive, k an index of KINDS,
    ordered by start, then kind.

    The base kinds match leftmost without overlap, each for itself; an assignment whose value has fewer than 8
    characters uses its text up but isn't kept. Base spans and allow-listed parts cut the candidates for entropy spans;
    each remainder of at least 20 characters is judged by itself.
    A null text counts as empty and has no spans; all columns of the input stay, but
    for one called ``into``, which is replaced. Row by row: no shuffle, so hot sources and repeated rows don't matter.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))

    def tagged(pattern: str, k: int) -> Column:
        return F.transform(spans_of(text, pattern), lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"), F.lit(k).alias("k"), x["m"].alias("m")))

    assign = F.filter(tagged(ASSIGN, 0), lambda x: F.length(F.regexp_extract(x["m"], ASSIGN, 1)) >= 8)
    docs = without(docs, into)
    spans, left = fresh(docs, "_base"), fresh(docs, "_left")
    base = docs.withColumn(spans, F.array_sort(F.concat(assign, tagged(ACCESS, 1), tagged(HEX, 2))))
    base = base.withColumn(left, blanked(text, F.col(spans)))
    loose = F.filter(
        F.transform(spans_of(F.col(left), CANDIDATE), lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"), F.lit(3).alias("k"), x["m"].alias("m"))),
        lambda x: is_secret(x["m"]),
    )
    return base.withColumn(into, F.array_sort(F.concat(spans, loose))).drop(spans, left)


def spans_text(spans: Column) -> Column:
    """`kind:start:end`, comma-joined."""
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.element_at(kinds, x["k"] + 1), x["s"], x["e"])), ",")


def redact(docs: DataFrame, text_col: str = "text", mask: str = "[SECRET]") -> DataFrame:
    """The documents with every secret span replaced by ``mask``; columns unchanged, null texts stay null.

    Overlapping spans are replaced once: what stands before a span's start and after the furthest end so far is kept.
    """
    text, into = F.col(text_col), fresh(docs, "secret_spans")
    masked = rebuilt(text, F.col(into), lambda at, s, e: F.when(s >= at, F.lit(mask)).otherwise(F.lit("")))
    scanned = scan_secrets(docs, text_col, into)
    return scanned.withColumn(text_col, F.when(text.isNotNull(), masked)).drop(into)
