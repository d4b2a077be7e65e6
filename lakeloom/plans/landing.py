"""RAW landing and Bronze loading.

``extract_to_raw`` replaces a cursor-paginated extraction loop with one
distributed job per table: cursor filter -> chunk numbering (fixed range cuts)
-> stamped JSON lines in one ``ingestion_date=/hour=/batch_id=`` folder, the chunk
as a column -> control rows (checkpoint, manifest) committed after the data. Counts
and cursors are observed while the rows are written.

``bronze_load`` reads a RAW tree (JSON lines and JSON-array files alike),
adds audit columns and canonical columns, and optionally skips files that an
earlier load already took (anti join on the loaded file list), so re-running
Bronze does not append the same rows again.
"""

from __future__ import annotations

import json
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import control
from ..functions.audit import batch_id, ingestion_date_utc, stamp_records, utc_now, with_load_audit
from ..functions.dates import TS_TEXT_MICROS, parse_ts
from ..operators.keyset import assign_chunks, cursor_filter
from ..registry import ENTITIES, EXTRACT_MODES, Entity
from ..session import scratch_path
from ..sinks.writers import write_jsonl_batch
from ..sources.files import read_raw
from . import medallion as M

_WM = "__wm"
_PK = "__pk"
_ROW = "__row"


def _typed_watermark(entity: Entity):
    c = F.col(entity.watermark)
    if entity.watermark_type == "int":
        return c.try_cast("long")
    return parse_ts(c)


def _decode(value: str | None):
    if value in (None, ""):
        return None
    try:
        return json.loads(value)
    except ValueError:
        return value


def extract_to_raw(spark: SparkSession, source: DataFrame, entity: Entity, raw_base: str,
                   control_base: str, mode: str = "incremental", chunk_size: int = 50000,
                   run_ts: datetime | None = None, cutoff: datetime | None = None,
                   no_watermark: str = "full", null_watermark: str = "include") -> dict:
    """Extract ``source`` rows after the saved cursor into RAW JSON-lines chunks.

    Returns the manifest row for the table. Modes: ``initial`` walks the key,
    ``incremental`` walks (watermark, key) up to ``cutoff`` (default: run time).
    Unknown modes are rejected. A run without a saved cursor starts at the first
    row. Without a watermark, incremental mode takes a full snapshot, or skips the
    table on request (``no_watermark="skip"``, recorded in the manifest). Rows
    whose watermark is NULL come with every incremental run, or not on request
    (``null_watermark="skip"``); the manifest counts them either way.

    An initial run goes on from its own ``max(pk)`` and hands ``max(wm, pk)`` to the
    incremental mode, which so starts after what the initial run took.
    """
    if mode not in EXTRACT_MODES:
        raise ValueError(f"mode must be one of {EXTRACT_MODES}, got {mode!r}")
    run_ts = (run_ts or utc_now()).astimezone(timezone.utc)
    run_id = batch_id(run_ts)
    cutoff = cutoff or run_ts
    cp_path = f"{control_base}/checkpoints"
    mf_path = f"{control_base}/manifests"
    started = utc_now().isoformat()
    base_row = {"run_id": run_id, "mode": mode, "started_utc": started, "chunk_size": chunk_size,
                "table": entity.name}
    control.record_run(spark, mf_path, [{**base_row, "status": "running"}])

    try:
        wm = entity.watermark
        pks = list(entity.keys)
        if mode == "incremental" and not wm and no_watermark == "skip":
            row = {**base_row, "status": "skipped_no_watermark", "rows": 0, "chunks": 0,
                   "ended_utc": utc_now().isoformat()}
            control.record_run(spark, mf_path, [row])
            return row

        cp = control.load_checkpoint(spark, cp_path, entity.name, mode)
        last_wm = cp.get("last_watermark")
        last_pk = _decode(cp.get("last_pk"))
        last_chunk = int(cp.get("last_chunk_index") or 0)

        df = source
        if wm:
            df = df.withColumn(_WM, _typed_watermark(entity))
        if pks:
            df = df.withColumn(_PK, F.struct(*[F.col(k) for k in pks]))
        if mode == "incremental" and wm:
            sliced = cursor_filter(df, mode, _WM, _PK if pks else None,
                                   last_wm=parse_wm_literal(last_wm, entity),
                                   last_pk=last_pk,
                                   cutoff=None if entity.watermark_type == "int"
                                   else parse_wm_literal(cutoff.isoformat(), entity),
                                   null_watermark=null_watermark)
            if not pks:  # rows of one watermark, maybe most of the table, may be parted by a hash
                sliced = sliced.withColumn(_ROW, F.xxhash64(*source.columns))
            order = [_WM, _PK if pks else _ROW]
        elif pks:
            sliced = cursor_filter(df, "initial", None, _PK, last_pk=last_pk if mode == "initial" else None)
            order = [_PK]
        else:
            sliced = df
            order = list(source.columns)

        chunked = assign_chunks(sliced, order, chunk_size, first_chunk=last_chunk + 1,
                                chunk_col="__chunk")
        stamped = stamp_records(chunked, entity.name, run_ts.isoformat(), run_id, mode,
                                F.col("__chunk"))
        batch_path = (f"{raw_base}/{entity.name}/ingestion_date={ingestion_date_utc(run_ts)}/"
                      f"hour={run_ts.strftime('%H')}/batch_id={run_id}")
        data_cols = [c for c in source.columns] + ["_source_table", "_ingestion_ts", "_batch_id",
                                                   "_ingestion_mode", "_chunk_index"]
        # Control values are found while the rows are written: counts, last chunk, cursors.
        seen = Observation()
        out = stamped.observe(seen, *_cursor_metrics(entity, pks, mode)).select(*data_cols)
        write_jsonl_batch(out, batch_path, chunk_size)
        stats = seen.get
        null_rows, rows = stats["null_wm"], stats["rows"]
        if mode == "incremental" and wm and null_watermark != "include":
            null_rows = df.filter(F.col(_WM).isNull()).count()
        new_chunk = stats["max_chunk"] or last_chunk
        cursor_wm, cursor_pk = stats["last_watermark"], stats["last_pk"]
        resume = stats["max_pk"] if mode == "initial" else cursor_pk
        saved = {
            "table": entity.name, "mode": mode, "watermark_column": wm,
            "pk_column": ",".join(pks) or None,
            "last_watermark": cursor_wm if cursor_wm is not None else last_wm,
            "last_pk": resume if resume is not None else cp.get("last_pk"),
            "last_chunk_index": int(new_chunk),
            "last_success_utc": run_ts.isoformat(),
            "row_count_last_run_table_total": int(rows),
            "batch_id": run_id,
            "last_raw_file_path": batch_path if rows else cp.get("last_raw_file_path"),
            "status": "completed",
        }
        control.save_checkpoint(spark, cp_path, saved)
        if mode == "initial" and cursor_wm is not None and not control.load_checkpoint(
                spark, cp_path, entity.name, "incremental"):
            control.save_checkpoint(spark, cp_path, {**saved, "mode": "incremental", "last_pk": cursor_pk})
        row = {**base_row, "status": "completed", "rows": int(rows),
               "chunks": int(new_chunk - last_chunk), "raw_path": batch_path,
               "null_watermark_rows": int(null_rows),
               "ended_utc": utc_now().isoformat()}
        control.record_run(spark, mf_path, [row])
        return row
    except Exception as exc:
        control.record_run(spark, mf_path, [{**base_row, "status": "failed", "error": str(exc),
                                             "ended_utc": utc_now().isoformat()}])
        raise


def parse_wm_literal(value, entity: Entity):
    """Saved cursor text -> literal for the typed watermark (UTC wall time text
    for timestamps, so the session time zone -- UTC -- reads it back exactly)."""
    if value is None:
        return None
    if entity.watermark_type == "int":
        return int(value)
    text = str(value).replace("Z", "+00:00")
    ts = datetime.fromisoformat(text)
    if ts.tzinfo is not None:
        ts = ts.astimezone(timezone.utc).replace(tzinfo=None)
    return ts.strftime("%Y-%m-%d %H:%M:%S.%f")


def _cursor_metrics(entity: Entity, pks: list[str], mode: str) -> list[Column]:
    """Rows, NULL watermarks, last chunk and, as text, the greatest (watermark, key) and key."""
    wm, none = entity.watermark, F.lit(None).cast("string")
    present = F.lit(True)
    for c in ([_WM] if wm else []) + ([_PK] if pks else []):
        present = present & F.col(c).isNotNull()
    best = F.max(F.when(present, F.struct(*([F.col(_WM).alias("wm")] if wm else []), *([F.col(_PK).alias("pk")] if pks else []))))

    def said(key: Column) -> Column:  # a JSON list of the key's columns; named once, as each naming is a maximum of its own
        return F.get(F.transform(F.array(key), lambda x: F.when(
            x.isNotNull(), F.to_json(F.array(*(x.getField(k).cast("string") for k in pks))))), F.lit(0))
    if not wm:
        last_wm = none
    elif entity.watermark_type == "int":
        last_wm = best.getField("wm").cast("string")
    else:
        last_wm = F.date_format(best.getField("wm"), TS_TEXT_MICROS)
    return [F.count(F.lit(1)).alias("rows"), (F.count_if(F.col(_WM).isNull()) if wm else F.count_if(F.lit(False))).alias("null_wm"),
            F.max("__chunk").alias("max_chunk"), (last_wm if wm else F.max(none)).alias("last_watermark"),
            (said(best.getField("pk")) if pks else F.max(none)).alias("last_pk"),
            (said(F.max(_PK)) if pks else F.max(none)).alias("max_pk")]


# --------------------------------------------------------------------------- bronze
def raw_files(spark: SparkSession, raw_path: str) -> DataFrame:
    """(path, batch_id) of the files of a RAW tree; a listing, no file is opened."""
    found = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(raw_path)
             .filter(F.col("length") > 0).select("path"))
    return found.withColumn("batch_id", F.nullif(F.regexp_extract("path", "/batch_id=([^/]+)/", 1), F.lit("")))


def new_files(spark: SparkSession, raw_path: str, loaded_files: DataFrame | None = None,
              committed: DataFrame | None = None) -> DataFrame:
    """Files not loaded before and, with ``committed`` (batch_id), not of an unfinished batch."""
    files = raw_files(spark, raw_path)
    if committed is not None:
        done = committed.select("batch_id").distinct().withColumn("ok", F.lit(True))
        files = files.join(done, "batch_id", "left").filter(F.col("batch_id").isNull() | F.col("ok")).drop("ok")
    if loaded_files is not None:
        files = files.join(loaded_files.select(F.col("_source_file").alias("path")).distinct(), "path", "left_anti")
    return files


def bronze_load(spark: SparkSession, raw_path: str, entity: str,
                schema: T.StructType | None = None, load_ts: datetime | None = None,
                loaded_files: DataFrame | None = None, committed: DataFrame | None = None) -> DataFrame:
    """RAW tree -> Bronze rows with audit + canonical columns.

    With ``loaded_files`` (column ``_source_file``) or ``committed`` (column
    ``batch_id``) the listing is compared first and only the files that are new
    and committed are opened; their paths come to the driver, as every file
    source needs them there.
    """
    fmt = ENTITIES[entity].raw_format if entity in ENTITIES else "json"
    if loaded_files is None and committed is None:
        raw = read_raw(spark, raw_path, fmt, schema)
    else:
        paths = [r["path"] for r in new_files(spark, raw_path, loaded_files, committed).select("path").collect()]
        if not paths and schema is None:
            schema = read_raw(spark, raw_path, fmt).schema
        raw = read_raw(spark, paths, fmt, schema) if paths else empty_source(spark, schema)
    return M.bronze_canonical(entity, with_load_audit(raw, load_ts))


def empty_source(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """A file source without files: it has the metadata columns a load asks for."""
    path = scratch_path(spark, "no-files")
    spark.createDataFrame([], schema).write.json(path)
    return spark.read.schema(schema).json(path)
