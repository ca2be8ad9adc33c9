"""Incremental ingest with Structured Streaming and keyed state.

What is known of a key is in the state store: of a case the stamp and digest of its newest version, of a self-help file
the time, length and digest of the text processed so far, which tell whether a text begins with it. No text is kept there. A
micro-batch reads its own arrivals and the state of their keys only, never what was stored before. Cases, and files, share a
state entry in groups of a fixed number, a few hundred each among millions, since a call of Python for every one costs far more
than the work on it. Its changes are appended in a folder of the batch's own that a retried batch overwrites; the current state
of a folder is the newest version of every key. With the RocksDB provider the state is on disk; the provider is set in the session.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from caselore.functions.text import has_text
from caselore.operators import selfhelp
from caselore.operators.changes import with_hash
from caselore.session import held
from caselore.sources.files import TRACKING, _or_empty

CASE = ["product_id", "case_id"]
DOCUMENTS = "product_id string, case_id string, part_no int, content string"
#: A version of a case is what one file has of it with one version number, null counting as 0. The newest is the one of the
#: highest number, then of the file last modified, then of the greatest path; it counts as a whole.
ARRIVALS = DOCUMENTS + ", version long"
CORPUS = DOCUMENTS + ", content_hash string, batch long"
TRACKED = TRACKING + ", batch long, step int"
COMPARED = TRACKING + ", step int, status string, new_chars int"
FILES = "product_id string, file_name string, content string, modified_ts timestamp_ntz"


def _stored(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return _or_empty(spark, lambda: spark.read.schema(schema).parquet(path), schema)


def newest(rows: DataFrame, keys: list[str], *version: str) -> DataFrame:
    """Rows of the newest version (of the highest batch) of each key: a maximum per key, joined back."""
    version = version or ("batch",)
    last = rows.groupBy(*keys).agg(F.max(F.struct(*version)).alias("last")).select(*keys, "last.*")
    return rows.join(last, [*keys, *version], "left_semi")


def read_corpus(spark: SparkSession, path: str) -> DataFrame:
    """The current corpus. A case is replaced as a whole, so versions are compared per case."""
    return newest(_stored(spark, path, CORPUS), CASE)


#: Cases are dealt to so many groups by a hash; a group has one state entry, the stamps and digests of its cases.
CASE_GROUPS = 1 << 16


def _newest_versions(policy: str):
    """For a group of cases: the parts of each case's newest version, if it is newer than the one known and its text is another."""
    def step(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        best, parts = {}, {}
        for frame in frames:
            columns = (frame[c].tolist() for c in ("product_id", "case_id", "version", "modified", "path", "part_no", "content"))
            for product, case_id, version, modified, path, part_no, content in zip(*columns, strict=True):
                case, stamp = (product, case_id), (int(version), int(modified), path)
                if case not in best or stamp > best[case]:
                    best[case], parts[case] = stamp, {}
                if stamp == best[case]:
                    mine = parts[case]
                    # parts without a number are all kept
                    part = (1, len(mine)) if part_no is None or part_no != part_no else (0, int(part_no))
                    # Of unlike texts of one part in one version the greatest.
                    mine[part] = content if mine.get(part) is None else max(mine[part], content or "")
        known = {(p, c): tuple(last) for p, c, *last in json.loads(state.get[0])} if state.exists else {}
        rows = []
        for case, stamp in best.items():
            last = known.get(case)
            if last and stamp < last[:3]:
                continue
            digest = hashlib.sha256(repr(sorted(parts[case].items())).encode()).hexdigest()
            known[case] = (*stamp, digest)
            if not last or (policy != "new_only" and digest != last[3]):
                rows += [(*case, None if part[0] else part[1], content) for part, content in parts[case].items()]
        state.update((json.dumps([(*case, *last) for case, last in known.items()]),))
        if rows:
            yield pd.DataFrame(rows, columns=["product_id", "case_id", "part_no", "content"], dtype=object)

    return step


def stream_cases(spark: SparkSession, source: str, corpus: str, checkpoint: str,
                 policy: str = "new_or_updated", files_per_batch: int | None = None) -> StreamingQuery:
    """Documents arriving as parquet files, upserted into the corpus folder."""
    if policy not in ("new_or_updated", "new_only"):
        raise ValueError(f"unknown policy {policy!r}")

    def upsert(batch: DataFrame, batch_id: int) -> None:
        with_hash(batch).write.mode("overwrite").parquet(f"{corpus}/batch={batch_id}")

    reader = spark.readStream.schema(ARRIVALS)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    arrivals = reader.parquet(source).select(
        *CASE, "part_no", "content", F.coalesce("version", F.lit(0)).alias("version"),
        F.unix_micros("_metadata.file_modification_time").alias("modified"), F.col("_metadata.file_path").alias("path"),
        F.pmod(F.xxhash64(*CASE), F.lit(CASE_GROUPS)).alias("case_group"))
    changed = arrivals.groupBy("case_group").applyInPandasWithState(
        _newest_versions(policy), DOCUMENTS, "known string", "append", GroupStateTimeout.NoTimeout)
    return (changed.writeStream.outputMode("append").foreachBatch(upsert)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


#: Files are dealt to fewer groups than cases, since a call takes longer than the work on some hundred files.
FILE_GROUPS = 1 << 14
TEXTS_PER_BATCH = 1000


def _digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def _next_versions(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """For a group of files: every version of a file that is not older than the one known, in order.

    processed_chars tells how many characters at its start are the text processed before it: null if there was none, 0 if that
    text was another.
    """
    versions: dict[tuple, set] = {}
    for frame in frames:
        for product, name, modified, content in zip(*(frame[c].tolist() for c in (*selfhelp.KEY, "modified_us", "content")), strict=True):
            versions.setdefault((product, name), set()).add((None if modified != modified or modified is None else int(modified), content))
    known = {(p, f): tuple(last) for p, f, *last in json.loads(state.get[0])} if state.exists else {}
    rows = []
    for file, found in versions.items():
        step = 0
        for modified, content in sorted(found, key=lambda v: (v[0] is None, v[0] or 0, v[1])):  # without a time last
            last = known.get(file)
            at, chars, digest = last or (None, None, None)
            if last and at is not None and (modified is None or modified < at):
                continue
            step += 1
            same = last and len(content) >= chars and _digest(content[:chars]) == digest
            rows.append((*file, content, modified, (chars if same else 0) if last else None, at, step))
            known[file] = (modified, len(content), _digest(content))
    if rows:
        state.update((json.dumps([(*file, *last) for file, last in known.items()]),))
        yield pd.DataFrame(rows, columns=[*selfhelp.KEY, "content", "modified_us", "processed_chars", "processed_us", "step"], dtype=object)


def stream_selfhelp(spark: SparkSession, source: str, sections: str, tracking: str, checkpoint: str,
                    files_per_batch: int | None = None) -> StreamingQuery:
    """Self-help files arriving as parquet rows: new sections and tracking rows are appended.

    Versions of a file are taken one after the other by their time, step n being the n-th one of a batch; a version that is
    older than the one processed last came too late and is left out. A batch is compared once: its tracking rows also say what
    they are (status) and how many characters at their end are new (new_chars), and its sections are written from them.
    """
    def ingest(batch: DataFrame, batch_id: int) -> None:
        batch = batch.withColumns({"modified_ts": F.timestamp_micros("modified_us").cast("timestamp_ntz"),
                                   "last_processed": F.timestamp_micros("processed_us").cast("timestamp_ntz"),
                                   "processed_content": F.substring("content", F.lit(1), F.col("processed_chars"))})
        diff = selfhelp.compared(batch.drop("modified_us", "processed_us", "processed_chars")).filter(F.col("status") != "unchanged")
        diff.select(*selfhelp.KEY, F.col("content").alias("processed_content"), F.col("modified_ts").alias("last_processed"),
                    F.char_length("content").alias("content_length"), "step", "status",
                    F.char_length("new_content").alias("new_chars")).write.mode("overwrite").parquet(f"{tracking}/batch={batch_id}")
        tracked = _stored(batch.sparkSession, f"{tracking}/batch={batch_id}", COMPARED)
        fresh = F.substring("processed_content", F.col("content_length") - F.col("new_chars") + 1, F.col("new_chars"))
        tracked.withColumns({"new_content": fresh, "modified_ts": F.col("last_processed")}).select(
            *selfhelp.KEY, "status", selfhelp.section_text().alias("section"), "step").write.mode("overwrite").parquet(f"{sections}/batch={batch_id}")

    reader = spark.readStream.schema(FILES)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    # Times travel as microseconds: the files' times have no zone.
    arrivals = reader.parquet(source).filter(has_text(F.col("content"))).select(
        *selfhelp.KEY, "content", F.unix_micros(F.col("modified_ts").cast("timestamp")).alias("modified_us"),
        F.pmod(F.xxhash64(*selfhelp.KEY), F.lit(FILE_GROUPS)).alias("file_group"))
    versions = arrivals.groupBy("file_group").applyInPandasWithState(
        _next_versions, "product_id string, file_name string, content string, modified_us long, processed_chars int, processed_us long, step int",
        "known string", "append", GroupStateTimeout.NoTimeout)
    # A stream keeps the settings it is started with. Texts go to Python and back in batches of this many rows.
    with held(spark, "spark.sql.execution.arrow.maxRecordsPerBatch", str(TEXTS_PER_BATCH)):
        return (versions.writeStream.outputMode("append").foreachBatch(ingest)
                .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def read_sections(spark: SparkSession, path: str) -> DataFrame:
    return _stored(spark, path, "product_id string, file_name string, status string, section string, batch long, step int")


def read_stream_tracking(spark: SparkSession, path: str) -> DataFrame:
    return newest(_stored(spark, path, TRACKED), selfhelp.KEY, "batch", "step")
