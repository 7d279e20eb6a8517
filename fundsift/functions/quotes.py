"""Quote repair of one delimited text line as Column expressions.

A field's *unescaped* quotes are those left once doubled quotes are taken away,
left to right. An odd number cannot be paired, so those quotes are dropped; an
even number is kept by doubling each.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SEPARATOR = ";"


def _fields(line: Column) -> Column:
    return F.split(line, SEPARATOR, -1)


def _has_quote(line: Column) -> Column:
    return F.instr(line, '"') > 0


def unescaped_quotes(field: Column) -> Column:
    unpaired = F.replace(field, F.lit('""'), F.lit(""))
    return F.length(unpaired) - F.length(F.replace(unpaired, F.lit('"'), F.lit("")))


def _odd(field: Column) -> Column:
    return unescaped_quotes(field) % 2 == 1


def _even(field: Column) -> Column:
    count = unescaped_quotes(field)
    return (count > 0) & (count % 2 == 0)


def has_redundant_quotes(line: Column) -> Column:
    """Some field holds an odd number of unescaped quotes."""
    return _has_quote(line) & F.exists(_fields(line), _odd)


def has_malformed_quotes(line: Column) -> Column:
    """Some field holds an even, non-zero number of unescaped quotes."""
    return _has_quote(line) & F.exists(_fields(line), _even)


def _rewrite_fields(line: Column, affected, rewrite) -> Column:
    fields = F.transform(_fields(line), lambda f: F.when(affected(f), rewrite(f)).otherwise(f))
    return F.when(_has_quote(line), F.array_join(fields, SEPARATOR)).otherwise(line)


def fix_redundant_quotes(line: Column) -> Column:
    """Drop the unescaped quotes of odd fields; doubled quotes stay."""
    return _rewrite_fields(line, _odd, lambda f: F.regexp_replace(f, '("")|"', "$1"))


def fix_malformed_quotes(line: Column) -> Column:
    """Double the unescaped quotes of even fields; doubled quotes stay."""
    return _rewrite_fields(line, _even, lambda f: F.regexp_replace(f, '""?', '""'))
