"""Size reduction of inventoried files with an injected reducer."""

from __future__ import annotations

import hashlib
from typing import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from vellum.functions.revision import file_name, file_stem, has_reduced_suffix
from vellum.functions.text import is_truthy
from vellum.sources import storage
from vellum.sources.deal import deal

MIB = 1024 ** 2
GIB = 1024 ** 3


def reduced_name(path) -> Column:
    """``<dir>/<stem>-reduced<suffix>`` beside ``path``."""
    p = path if isinstance(path, Column) else F.col(path)
    name = file_name(p)
    stem = file_stem(p)
    directory = F.regexp_replace(p, r"[^/\\]*$", "")
    suffix = F.substring(name, F.length(stem) + 1, F.lit(1 << 30))
    return F.concat(directory, stem, F.lit("-reduced"), suffix)


def reduction_plan(inventory: DataFrame, base_dir: str, output_dir: str | None = None,
                   replace_original: bool = True) -> DataFrame:
    """Decide per row: no path, already reduced, or reduce to a destination
    (F5, F6, P9, P23). Already-reduced rows are flagged True as well."""
    nonempty = lambda c: F.when(F.col(c) != "", F.col(c))
    raw = F.coalesce(nonempty("full_path"), nonempty("relative_path"))
    source = F.when(F.startswith(raw, F.lit("/")), raw).otherwise(
        F.concat(F.lit(base_dir.rstrip("/") + "/"), raw))
    reduced_flag = is_truthy(F.col("reduced")) if "reduced" in inventory.columns else F.lit(False)
    already = reduced_flag | has_reduced_suffix(source)
    if output_dir is not None:
        rel = F.coalesce(nonempty("relative_path"), file_name(source))
        destination = reduced_name(F.concat(F.lit(output_dir.rstrip("/") + "/"), rel))
    elif replace_original:
        destination = source
    else:
        destination = reduced_name(source)
    action = (F.when(raw.isNull(), F.lit("no_path"))
              .when(already, F.lit("already_reduced"))
              .otherwise(F.lit("reduce")))
    return inventory.select(
        "*",
        F.when(raw.isNotNull(), source).alias("source_path"),
        action.alias("action"),
        F.when(action == "reduce", destination).when(action == "already_reduced", source)
         .alias("destination"),
        F.when(raw.isNotNull(), F.lit(True)).otherwise(reduced_flag).alias("reduced_after"),
    )


REDUCE_RESULT = T.StructType([
    T.StructField("source_path", T.StringType()),
    T.StructField("destination", T.StringType()),
    T.StructField("staged_path", T.StringType()),
    T.StructField("original_size", T.LongType()),
    T.StructField("reduced_size", T.LongType()),
    T.StructField("reduced_md5", T.StringType()),
    T.StructField("error", T.StringType()),
])
_COLUMNS = [f.name for f in REDUCE_RESULT.fields]


def staged_path(destination: str) -> str:
    """Temporary sibling a reduced file is written to before it is committed."""
    head, _, tail = destination.rpartition("/")
    return f"{head}/.{tail}.reduced-temp" if head or destination.startswith("/") else f".{tail}.reduced-temp"


def reduce_files(plan: DataFrame, reducer: Callable[[bytes], bytes],
                 read: Callable[[str], bytes] = storage.read_bytes,
                 write: Callable[[str, bytes], None] = storage.write_bytes, size: str = "file_size") -> DataFrame:
    """Stage 1 of a reduction: run ``reducer`` on every source of a 'reduce'
    row, once however many rows name it, inside ``mapInPandas`` (X2) and write
    the result to a temporary sibling of its destination (a path or a URI on
    a file system that all executors share). Sources are never touched here,
    so a retried task redoes its files from the originals. Files are dealt to
    tasks by the bytes in column ``size``, if the plan has it. Errors become
    rows."""
    todo = plan.filter(F.col("action") == "reduce").groupBy("source_path").agg(
        F.min("destination").alias("destination"), F.max(F.col(size) if size in plan.columns else F.lit(None).cast("long")).alias("bytes"))
    todo = deal(todo, "source_path", F.col("bytes").try_cast("long")).drop("bytes")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for src, dst in zip(pdf["source_path"], pdf["destination"]):
                try:
                    data = read(src)
                    small = reducer(data)
                    write(staged_path(dst), small)
                    out.append((src, dst, staged_path(dst), len(data), len(small), hashlib.md5(small).hexdigest(), None))
                except Exception as exc:
                    out.append((src, dst, None, None, None, None, f"{type(exc).__name__}: {exc}"))
            yield pd.DataFrame(out, columns=_COLUMNS)

    return todo.mapInPandas(run, REDUCE_RESULT)


def commit_one(staged: str, destination: str, md5: str) -> str | None:
    """Move a staged file into place; an error text if it cannot be. A staged
    file that is gone counts as moved only if the destination holds its very
    bytes."""
    found = storage.md5_of(staged)
    if found == md5:
        storage.move(staged, destination)
        return None
    if found is not None:
        return "staged file differs from the reduced content"
    return None if storage.md5_of(destination) == md5 else "staged file missing"


def commit_files(results: DataFrame, commit: Callable[[str, str, str], str | None] = commit_one) -> DataFrame:
    """Stage 2: move every staged file over its destination. Run it on
    results that are already stored (checkpointed): a retried task finds its
    files either still staged or already moved, checked by their MD5. Rows
    whose file is lost get an error and no sizes."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            errors = []
            for staged, dst, md5, err in zip(pdf["staged_path"], pdf["destination"], pdf["reduced_md5"], pdf["error"]):
                if err is None:
                    try:
                        err = commit(staged, dst, md5)
                    except Exception as exc:
                        err = f"{type(exc).__name__}: {exc}"
                errors.append(err)
            yield pdf.assign(error=errors)

    return deal(results, "destination", F.col("reduced_size")).mapInPandas(run, REDUCE_RESULT)


def reduction_accounting(results: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Bytes before/after and saved, in bytes, MiB and GiB.
    Only rows reduced in this run count."""
    ok = results.filter(F.col("error").isNull()) if "error" in results.columns else results
    grouped = ok.groupBy(*by) if by else ok.groupBy()
    agg = grouped.agg(
        F.count(F.lit(1)).alias("n_reduced"),
        F.sum("original_size").cast("bigint").alias("original_bytes"),
        F.sum("reduced_size").cast("bigint").alias("reduced_bytes"),
    )
    saved = F.col("original_bytes") - F.col("reduced_bytes")
    return agg.select("*", saved.alias("saved_bytes"),
                      F.round(saved / F.lit(MIB), 2).alias("saved_mib"),
                      F.round(saved / F.lit(GIB), 2).alias("saved_gib"))


def reduction_writeback(plan: DataFrame, results: DataFrame) -> DataFrame:
    """Reduced path, name and size onto the rows of a :func:`reduction_plan`
    (J4), which still are the inventory's rows: results have one row a source,
    so rows never multiply, whatever their relative paths are. Rows that were
    not reduced are set aside before the join. The stored md5 is kept; the
    reduced file's md5 is added beside it (Q19)."""
    own = [c for c in plan.columns if c not in ("source_path", "action", "destination", "reduced_after")]
    res = results.filter(F.col("error").isNull()).select(
        "source_path", F.col("destination").alias("_dst"), F.col("reduced_size").alias("_size"), "reduced_md5")
    planned = plan.filter(F.col("action") == "reduce").join(res, "source_path", "left")
    rest = plan.filter(F.col("action") != "reduce")
    for name, kind in (("_dst", "string"), ("_size", "bigint"), ("reduced_md5", "string")):
        rest = rest.withColumn(name, F.lit(None).cast(kind))
    rows = planned.unionByName(rest)
    done = F.col("_size").isNotNull()
    flag = done | (F.col("action") == "already_reduced")
    cols = []
    for c in own:
        if c == "full_path":
            cols.append(F.when(done, F.col("_dst")).otherwise(F.col(c)).alias(c))
        elif c == "filename":
            cols.append(F.when(done, file_name(F.col("_dst"))).otherwise(F.col(c)).alias(c))
        elif c == "file_size":
            cols.append(F.when(done, F.col("_size")).otherwise(F.col(c)).alias(c))
        elif c == "reduced":
            stored = F.col(c) if dict(plan.dtypes)[c] == "boolean" else is_truthy(F.col(c))
            cols.append(F.when(flag, F.lit(True)).otherwise(F.coalesce(stored, F.lit(False))).alias(c))
        else:
            cols.append(F.col(c))
    return rows.select(*cols, "reduced_md5")


CONTENT_RESULT = T.StructType([
    T.StructField("key", T.StringType()),
    T.StructField("original_size", T.LongType()),
    T.StructField("reduced_size", T.LongType()),
    T.StructField("reduced_md5", T.StringType()),
    T.StructField("error", T.StringType()),
])


def reduce_contents(df: DataFrame, key: str, content: str,
                    reducer: Callable[[bytes], bytes]) -> DataFrame:
    """Run ``reducer`` over a BINARY content column inside ``mapInPandas``
    (X2) when the bytes are already in a table rather than in files. Only
    sizes and the reduced MD5 come back; the reduced bytes are not kept."""
    src = df.select(F.col(key).cast("string").alias("key"), F.col(content).alias("content"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for k, data in zip(pdf["key"], pdf["content"]):
                try:
                    data = bytes(data)
                    small = reducer(data)
                    out.append((k, len(data), len(small), hashlib.md5(small).hexdigest(), None))
                except Exception as exc:
                    out.append((k, None, None, None, f"{type(exc).__name__}: {exc}"))
            yield pd.DataFrame(out, columns=[f.name for f in CONTENT_RESULT.fields])

    return src.mapInPandas(run, CONTENT_RESULT).withColumnRenamed("key", key)
