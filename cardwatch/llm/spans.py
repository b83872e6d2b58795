"""Places of pattern matches as column expressions (no Python on the executors).

Offsets count code points and ends are exclusive.  Patterns must match at
least one character.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Matches that are gathered step by step; more of them are gathered in such runs.
RUN = 200
MATCH = "array<struct<value:string,start:int,end:int,before:string,after:string>>"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` with ``value`` evaluated once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def matches(text: Column, gate: Column, pattern: str, context: int = 40) -> Column:
    """All leftmost non-overlapping matches: value, start, end and up to ``context`` characters before and after.

    ``gate`` is a cheap condition that holds for every text with a match;
    other texts, and null, get an empty array.
    """
    parts = F.struct(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("hit"),
                     F.split(text, pattern, -1).alias("gap"))

    def places(s: Column) -> Column:
        def run(first: Column, last: Column) -> Column:
            """Matches ``first`` to ``last`` with offsets from the end of the match before, and how far they reach."""
            start = F.struct(F.lit(0).alias("at"), F.array().cast(MATCH).alias("out"))

            def step(acc: Column, i: Column) -> Column:
                hit, gap, after = F.get(s["hit"], i), F.get(s["gap"], i), F.get(s["gap"], i + 1)
                begin = acc["at"] + F.length(gap)
                end = begin + F.length(hit)
                one = F.struct(hit.alias("value"), begin.alias("start"), end.alias("end"),
                               F.right(gap, F.lit(context)).alias("before"), F.left(after, F.lit(context)).alias("after"))
                return F.struct(end.alias("at"), F.concat(acc["out"], F.array(one)).alias("out"))

            return F.aggregate(F.sequence(first, last), start, step)

        n = F.size(s["hit"])

        def long() -> Column:
            """Runs of ``RUN`` matches, then moved by where each run begins: an array that grows is copied at each step."""
            runs = F.transform(F.sequence(F.lit(0), F.floor((n - 1) / RUN).cast("int")),
                               lambda k: run(k * RUN, F.least(k * RUN + (RUN - 1), n - 1)))
            begins = lambda rs: F.aggregate(rs, F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out")),
                                            lambda acc, r: F.struct((acc["at"] + r["at"]).alias("at"),
                                                                    F.concat(acc["out"], F.array(acc["at"])).alias("out")))["out"]
            moved = lambda r, by: F.transform(r["out"], lambda m: F.struct(
                m["value"].alias("value"), (m["start"] + by).alias("start"), (m["end"] + by).alias("end"), m["before"].alias("before"),
                m["after"].alias("after")))
            return let(runs, lambda rs: let(begins(rs), lambda bs: F.flatten(F.zip_with(rs, bs, moved))))

        return F.when(n > RUN, long()).when(n > 0, run(F.lit(0), n - 1)["out"])

    return F.coalesce(F.when(gate, let(parts, places)), F.array().cast(MATCH))


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(value: Column) -> Column:
    """True if the digits of the value pass the Luhn check."""
    d = F.transform(F.split(F.reverse(digits(value)), ""), lambda c: c.cast("int"))
    doubled = F.transform(F.filter(d, lambda x: x.isNotNull()),
                          lambda x, i: F.when(i % 2 == 0, x).when(x > 4, 2 * x - 9).otherwise(2 * x))
    return F.aggregate(doubled, F.lit(0), lambda a, x: a + x) % 10 == 0


def joined(spans: Column) -> Column:
    """``kind:start:end`` of an ordered array of spans, comma-joined."""
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])))


def replaced(text: Column, spans: Column) -> Column:
    """The text with each span (ordered by start) replaced by its kind in angle brackets; overlapping spans become one."""
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(acc: Column, s: Column) -> Column:
        fresh = F.concat(acc["out"], F.substring(text, acc["at"] + 1, s["start"] - acc["at"]), F.lit("<"), F.upper(s["kind"]), F.lit(">"))
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"),
                        F.when(s["start"] >= acc["at"], fresh).otherwise(acc["out"]).alias("out"))

    done = F.aggregate(spans, start, step, lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.length(text))))
    return F.when(F.size(spans) > 0, done).otherwise(text)
