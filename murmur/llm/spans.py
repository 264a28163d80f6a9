"""Places of pattern matches as native expressions: positions in code points, ends exclusive."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

SPAN = "array<struct<s: int, e: int, v: string>>"
#: A private-use character that stands for a separator inside a token; such characters of a text itself are put out of the way first.
JOINT = ""


def matches(text: Column, pattern: str, guard: Column) -> Column:
    """Leftmost non-overlapping matches of ``pattern`` as an array of (s, e, v); texts for which ``guard`` doesn't hold are
    not searched. What stands between the matches and the matches themselves give the places."""
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    parts = F.arrays_zip(F.slice(F.split(text, pattern, -1), 1, F.size(values)).alias("g"), values.alias("v"))
    start = F.struct(F.lit(0).alias("at"), F.array().cast(SPAN).alias("out"))

    def step(acc, p):
        s = acc["at"] + F.length(p["g"])
        e = s + F.length(p["v"])
        return F.struct(e.alias("at"), F.array_append(acc["out"], F.struct(s.alias("s"), e.alias("e"), p["v"].alias("v"))).alias("out"))

    return F.when(guard, F.aggregate(parts, start, step, lambda acc: acc["out"])).otherwise(F.array().cast(SPAN))


def of_kind(spans: Column, kind: int, keep: Callable[[Column], Column] | None = None) -> Column:
    """(s, k, e) of the spans for whose text ``keep`` holds; they sort by start, then kind."""
    if keep is not None:
        spans = F.filter(spans, lambda x: keep(x["v"]))
    return F.transform(spans, lambda x: F.struct(x["s"].alias("s"), F.lit(kind).alias("k"), x["e"].alias("e")))


def joined(text: Column, separators: str, left: str, right: str) -> Column:
    """``text`` with JOINT in place of each separator (a character class's inside) between a left and a right character. Each character
    stays one, so places stay. Patterns can then use one character class where they would need a repeated group."""
    return F.regexp_replace(F.translate(text, JOINT, ""), f"(?<=[{left}])[{separators}](?=[{right}])", JOINT)


def digits(v: Column) -> Column:
    return F.regexp_replace(v, "[^0-9]", "")


def luhn(v: Column) -> Column:
    """Does the checksum of the text's digits hold?"""
    d = F.reverse(digits(v))

    def add(a, i):
        x = F.ascii(F.substring(d, i, F.lit(1))) - 48
        return a + F.when(i % 2 == 1, x).when(x > 4, 2 * x - 9).otherwise(2 * x)

    return F.aggregate(F.sequence(F.lit(1), F.length(d)), F.lit(0), add) % 10 == 0


def octets(v: Column) -> Column:
    """Are all dot-separated numbers at most 255?"""
    return F.forall(F.split(v, "[.]"), lambda p: F.regexp_like(p, F.lit("^0*(?:[0-9]{1,2}|1[0-9][0-9]|2[0-4][0-9]|25[0-5])$")))


def listing(spans: Column, kinds: tuple[str, ...]) -> Column:
    """kind:start:end of each span in the array's order, joined by commas."""
    names = F.array(*[F.lit(k) for k in kinds])
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.element_at(names, x["k"] + 1), x["s"].cast("string"), x["e"].cast("string"))), ",")


def apart(span: Column, others: Column) -> Column:
    """Does the span overlap none of the others?"""
    return ~F.exists(others, lambda o: (o["s"] < span["e"]) & (span["s"] < o["e"]))
