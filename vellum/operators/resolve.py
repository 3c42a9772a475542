"""Resolve inventory paths against a file listing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from vellum.functions.text import blank_to_null


def _parent(path: str) -> str:
    p = path.rstrip("/")
    head = p.rsplit("/", 1)[0] if "/" in p else "."
    return head or "/"


def _join(base: str, rel: Column) -> Column:
    return F.concat(F.lit(base.rstrip("/") + "/"), rel)


def candidates(raw_columns: list[str], base_dir: str, search_parent: bool = True,
               first_non_empty: bool = False) -> Column:
    """Ordered candidate paths: each non-empty raw path as is when absolute,
    else under ``base_dir`` and then under its parent."""
    raws = [blank_to_null(F.col(c)) for c in raw_columns]
    if first_non_empty:
        raws = [F.coalesce(*raws)]
    parts = []
    for raw in raws:
        absolute = F.startswith(raw, F.lit("/"))
        rel_list = [_join(base_dir, raw)]
        if search_parent:
            rel_list.append(_join(_parent(base_dir), raw))
        parts.append(F.when(raw.isNull(), F.array().cast("array<string>"))
                      .when(absolute, F.array(raw))
                      .otherwise(F.array(*rel_list)))
    return F.concat(*parts) if len(parts) > 1 else parts[0]


def resolve_paths(rows: DataFrame, listing: DataFrame, base_dir: str,
                  raw_columns: tuple[str, ...] = ("full_path", "relative_path"),
                  search_parent: bool = True, first_non_empty: bool = False,
                  listing_path: str = "path") -> DataFrame:
    """Add ``resolved_path``: the first candidate present in ``listing``.

    What a row resolves to depends on its raw paths alone, so each distinct
    combination of them is resolved once: its candidates are exploded with
    their position and semi-joined with the listing, and the smallest
    position is kept (a handful of rows each). Rows without any raw path have
    no candidate and are set aside before the join.
    """
    raws = list(raw_columns)
    some = F.greatest(*[F.coalesce(F.col(c) != "", F.lit(False)) for c in raws], F.lit(False))
    cand = candidates(raws, base_dir, search_parent, first_non_empty)
    exploded = rows.filter(some).select(*raws).distinct().select(*raws, F.posexplode(cand).alias("_pos", "_cand"))
    files = listing.select(F.col(listing_path).alias("_cand"))
    hits = exploded.join(files, "_cand", "left_semi")
    best = hits.groupBy(*raws).agg(F.min_by("_cand", "_pos").alias("resolved_path"))
    best = best.select(*[F.col(c).alias(f"_raw{k}") for k, c in enumerate(raws)], "resolved_path")
    same = F.lit(True)
    for k, c in enumerate(raws):
        same = same & F.col(c).eqNullSafe(F.col(f"_raw{k}"))
    found = rows.filter(some).join(best, same, "left").select(*rows.columns, "resolved_path")
    return found.unionByName(rows.filter(~some).withColumn("resolved_path", F.lit(None).cast("string")))


def unresolved(resolved: DataFrame) -> DataFrame:
    """Rows without any existing candidate, as error rows (F8, Q18)."""
    return (resolved.filter(F.col("resolved_path").isNull())
                    .withColumn("error", F.lit("file not found")))
