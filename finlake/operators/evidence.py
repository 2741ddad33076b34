"""Attestations of published rows: a count and digests that don't depend on their order."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from finlake.functions import expr
from finlake.operators import multiset

#: What an attestation is compared by; the last is lacking in records of before it was kept.
COMPARED = ("rows", "row_digest", "key_digest", "set_digest")


def _as_number(digest: F.Column) -> F.Column:
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("decimal(38,0)")


def attest(frame: DataFrame, keys: list[str], by: list[str] | None = None, euros: bool = False, lanes: bool = False) -> DataFrame:
    """rows, row_digest and key_digest: sums of 60 bits of each row's SHA-256, so that parts can be added up; and the EUR of rows
    that have any, unless split `by` something and not wanted. lanes: set_digest, too, which nobody can meet by choice of rows."""
    columns = [F.col(c) for c in sorted(frame.columns) if c not in (by or [])]
    row, key = expr.payload(*columns), expr.payload(*[F.col(k) for k in keys])
    with_eur = "amount_eur" in frame.columns and (euros or not by)
    if lanes:
        # 60 bits of a digest are 15 hex digits.
        # A column first, so that a row is digested once and each step's code is small enough to be compiled.
        marked = frame.withColumns({"_row": row, "_key": key})
        words = F.concat(F.lit("0"), F.substring("_row", 1, 15), F.lit("0"), F.substring("_key", 1, 15), *multiset.lengthened(F.col("_row")))
        found = multiset.sums(marked, by or [], words, ["row_digest", "key_digest"], "amount_eur" if with_eur else None)
        euro = [expr.zero(F.col("amount")).cast("string").alias("eur")] if with_eur else []
        return found.select(*(by or []), "rows", "row_digest", "key_digest", F.col("digest").alias("set_digest"), *euro)
    marked = frame.withColumns({"_row": _as_number(row), "_key": _as_number(key)})
    euro = [expr.zero(F.sum("amount_eur")).cast("string").alias("eur")] if with_eur else []
    sums = [F.count("*").alias("rows"), F.coalesce(F.sum("_row"), F.lit(0)).cast("string").alias("row_digest"), F.coalesce(F.sum("_key"), F.lit(0)).cast("string").alias("key_digest"), *euro]
    return marked.groupBy(*by).agg(*sums) if by else marked.agg(*sums)


def is_recorded(now: Row | dict, held: dict) -> bool:
    """Whether an attestation is the one that `held` records."""
    return all(now[c] == held[c] for c in COMPARED if c in held)


def signature(frame: DataFrame, name: str, what: str, keys: list[str], columns: list[str] | None = None) -> DataFrame:
    """One row: name, what, rows, key_digest, row_digest (of `columns`) and eur, whose digests can be added up."""
    euro = F.sum("amount_eur") if "amount_eur" in frame.columns else F.lit(None)
    frame = frame.withColumns({"_key": _as_number(expr.payload(*[F.col(k) for k in keys])), "_row": _as_number(expr.payload(*[F.col(c) for c in columns or keys]))})
    zero = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("decimal(38,0)")
    out = frame.agg(F.count("*").alias("rows"), zero("_key").alias("key_digest"), zero("_row").alias("row_digest"), expr.zero(euro).alias("eur"))
    return out.select(F.lit(name).alias("name"), F.lit(what).alias("what"), "rows", "key_digest", "row_digest", "eur")


def reconciled(found: DataFrame) -> DataFrame:
    """Read-back against what was meant, per name, from signatures of `source`, `trusted` and `quarantine` (as committed),
    `meant_trusted` and `meant_quarantine`, and `all` and `meant_all` over all deliveries."""
    of = lambda what, c: F.max(F.when(F.col("what") == what, F.col(c)))
    columns = {f"{w}_{c}": of(w, c) for w in ("source", "trusted", "quarantine", "meant_trusted", "meant_quarantine", "all", "meant_all") for c in ("rows", "key_digest", "row_digest", "eur")}
    out = found.groupBy("name").agg(*[v.alias(k) for k, v in columns.items()])
    same = lambda a, b, *cs: [F.col(f"{a}_{c}").eqNullSafe(F.col(f"{b}_{c}")) for c in cs]
    both = lambda xs: reduce(lambda a, b: a & b, xs)
    off = F.abs(F.col("source_eur") - F.col("trusted_eur") - F.col("quarantine_eur")) + F.abs(F.col("all_eur") - F.col("meant_all_eur"))
    out = out.withColumns(
        {
            "source_accounted": F.col("source_rows") == F.col("trusted_rows") + F.col("quarantine_rows"),
            "batch_keys_match": both(same("trusted", "meant_trusted", "rows", "key_digest")),
            "global_keys_match": both(same("all", "meant_all", "rows", "key_digest")),
            "quarantine_matches": both(same("quarantine", "meant_quarantine", "rows", "row_digest")),
            "eur_difference": off.cast(expr.MONEY),
        }
    )
    rows = both([F.col(c) for c in ("source_accounted", "batch_keys_match", "global_keys_match", "quarantine_matches")])
    return out.withColumns({"rows_match": rows, "eur_matches": F.col("eur_difference") == 0})
