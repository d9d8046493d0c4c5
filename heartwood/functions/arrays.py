"""Folds over arrays whose cost stays far below the square of the array's length."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is evaluated once however often body refers to it."""
    return F.transform(F.array(value), body)[0]


def _groups(xs: Column, size: Column) -> Column:
    return F.sequence(F.lit(0), F.floor((F.size(xs) - 1) / size).cast("int"))


def _root(xs: Column) -> Column:
    return F.greatest(F.lit(1), F.ceil(F.sqrt(F.size(xs).cast("double")))).cast("int")


def running(values: Column, step: Callable[[Column, Column], Column]) -> Column:
    """For each of an array of non-negative ints, ``step`` folded over those before it, from 0.

    Appending to a list copies it, so sums are taken in groups of about the
    square root of their number: n^1.5 short copies, not n^2.
    """
    none = F.expr("cast(array() as array<int>)")

    def fold(xs: Column, start: Column) -> Column:
        zero = F.struct(start.alias("at"), none.alias("out"))
        return F.aggregate(xs, zero, lambda a, x: F.struct(step(a["at"], x).alias("at"), F.concat(a["out"], F.array(a["at"])).alias("out")), lambda a: a["out"])

    def grouped(v: Column) -> Column:
        part = lambda g: F.slice(v["xs"], g * v["size"] + 1, v["size"])
        totals = F.transform(_groups(v["xs"], v["size"]), lambda g: F.aggregate(part(g), F.lit(0), step))
        return F.flatten(F.transform(fold(totals, F.lit(0)), lambda start, g: fold(part(g), start)))

    return let(values, lambda xs: F.when(F.size(xs) > 0, let(F.struct(xs.alias("xs"), _root(xs).alias("size")), grouped)).otherwise(none))


def emitted(values: Column, carry: Column, step: Callable[[Column, Column], tuple[Column, Column, Column]]) -> Column:
    """struct(out array<string>, carry): a fold over strings that now and then puts out one.

    ``step`` of (carry, value) gives whether a string is put out, which, and
    the next carry. As in ``running``, what is put out gathers in groups.
    """
    strings = F.expr("cast(array() as array<string>)")

    def inner(xs: Column, start: Column) -> Column:
        def each(a: Column, x: Column) -> Column:
            some, what, then = step(a["carry"], x)
            return F.struct(F.when(some, F.concat(a["out"], F.array(what))).otherwise(a["out"]).alias("out"), then.alias("carry"))

        return F.aggregate(xs, F.struct(strings.alias("out"), start.alias("carry")), each)

    def grouped(v: Column) -> Column:
        part = lambda g: F.slice(v["xs"], g * v["size"] + 1, v["size"])
        zero = F.struct(F.expr("cast(array() as array<array<string>>)").alias("out"), carry.alias("carry"))
        group = lambda a, g: let(inner(part(g), a["carry"]), lambda r: F.struct(F.concat(a["out"], F.array(r["out"])).alias("out"), r["carry"].alias("carry")))
        return F.aggregate(_groups(v["xs"], v["size"]), zero, group, lambda a: F.struct(F.flatten(a["out"]).alias("out"), a["carry"].alias("carry")))

    nothing = F.struct(strings.alias("out"), carry.alias("carry"))
    return let(values, lambda xs: F.when(F.size(xs) > 0, let(F.struct(xs.alias("xs"), _root(xs).alias("size")), grouped)).otherwise(nothing))
