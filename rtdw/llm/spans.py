"""Places of regular-expression matches, as Spark expressions only.

``split`` gives what lies between the matches and ``regexp_extract_all`` the matches; running sums of their lengths are
the places, in code points. Matches are cut into blocks first, as taking a part of an array costs its whole length: it is
done once a block and not once a match.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BLOCK = 1024
MATCH_TYPE = "array<struct<start:bigint,end:bigint,value:string>>"


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def _sums(numbers: Column) -> Column:
    """0 and the running sums of a short array."""
    zero = F.array(F.lit(0).cast("long"))
    return F.aggregate(numbers, zero, lambda a, x: F.concat(a, F.array(F.element_at(a, -1) + x)))


def matches(text: Column, pattern: str, maybe: Column | None = None) -> Column:
    """All matches in order: ``start``, ``end`` (exclusive) and ``value``.

    ``maybe`` is a cheap condition that holds wherever the pattern matches; elsewhere, and for null, the array is empty.
    """
    none = F.array().cast(MATCH_TYPE)
    raw = F.struct(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("m"), F.split(text, pattern, -1).alias("p"))

    def block(v: Column, b: Column) -> Column:
        """The values of a block, the gaps before them, and the running sums of both."""
        parts = [F.slice(v[name], b * BLOCK + 1, F.lit(BLOCK)) for name in ("m", "p")]

        def summed(w: Column) -> Column:
            lengths = F.transform(w["m"], lambda m, i: (F.length(m) + F.length(F.get(w["p"], i))).cast("long"))
            return F.struct(w["m"].alias("m"), w["p"].alias("p"), _sums(lengths).alias("n"))

        return _let(F.struct(parts[0].alias("m"), parts[1].alias("p")), summed)

    def with_starts(blocks: Column) -> Column:
        return F.struct(blocks.alias("blocks"), _sums(F.transform(blocks, lambda w: F.element_at(w["n"], -1))).alias("starts"))

    def places(v: Column) -> Column:
        def one(w: Column, b: Column) -> Column:
            def place(m: Column, i: Column) -> Column:
                start = F.get(v["starts"], b) + F.get(w["n"], i) + F.length(F.get(w["p"], i))
                return _let(start, lambda s: F.struct(s.alias("start"), (s + F.length(m)).alias("end"), m.alias("value")))

            return F.transform(w["m"], place)

        return F.flatten(F.transform(v["blocks"], one))

    def found(v: Column) -> Column:
        last = F.floor((F.size(v["m"]) - 1) / BLOCK).cast("int")
        blocks = F.transform(F.sequence(F.lit(0), last), lambda b: block(v, b))
        return F.when(F.size(v["m"]) > 0, _let(_let(blocks, with_starts), places)).otherwise(none)

    condition = text.isNotNull() if maybe is None else text.isNotNull() & maybe
    return F.when(condition, _let(raw, found)).otherwise(none)


def of_kind(spans: Column, number: int) -> Column:
    """How many spans are of a kind. (A second parameter of the lambda would be the element's index.)"""
    return F.size(F.filter(spans, lambda s: s["kind"] == number)).cast("long")


def joined(spans: Column, kinds: tuple[str, ...]) -> Column:
    """``kind:start:end`` of an array of structs (start, kind as number, end), comma-joined."""
    names = F.array(*(F.lit(k) for k in kinds))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ",")
