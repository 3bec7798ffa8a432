"""Captions in small batches through a pluggable captioner."""

from collections.abc import Callable, Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pixsieve import schema as S
from pixsieve.models import per_worker
from pixsieve.sources.manifest import dense_index

_COLUMNS = S.ANNOTATION_SCHEMA.fieldNames()
LAYOUT = "row_idx bigint, " + ", ".join(f"{c} string" for c in _COLUMNS)


def read_file(path: str) -> bytes:
    """Bytes of an image in storage that the executors share."""
    if "://" in path:
        from pyarrow import fs

        system, inner = fs.FileSystem.from_uri(path)
        with system.open_input_stream(inner) as stream:
            return stream.read()
    with open(path, "rb") as stream:
        return stream.read()


def caption_batch(
    rows: list[tuple[str, str, Any]], captioner, model_name: str, load: Callable[[Any], Any]
) -> list[dict]:
    """One batch: ``rows`` are (sample id, image path, what ``load`` opens).

    A row whose image cannot be opened fails alone. If the captioner fails, all other rows of
    the batch fail with its message. Rows with the same id share one result; a failed opening
    goes before any other.
    """

    def record(sample_id, path, caption="", error=None):
        status = S.SUCCESS if error is None else S.FAILED
        return dict(zip(_COLUMNS, (sample_id, path, caption, model_name, status, error)))

    images, opened, failed = [], [], []
    for sample_id, path, payload in rows:
        try:
            images.append(load(payload))
            opened.append((sample_id, path))
        except Exception as error:
            failed.append(record(sample_id, path, error=str(error)))
    done = []
    if opened:
        try:
            captions = captioner.caption(images)
            done = [record(i, p, caption=c.strip()) for (i, p), c in zip(opened, captions)]
        except Exception as error:
            done = [record(i, p, error=str(error)) for i, p in opened]
    by_id = {r["sample_id"]: r for r in done + failed}
    return [by_id[sample_id] for sample_id, _, _ in rows]


def first_samples(df: DataFrame, n: int | None) -> DataFrame:
    """The first ``n`` rows in input order; ``None`` means all."""
    return df if n is None else df.orderBy(S.ROW_INDEX).limit(n)


def number_batches(df: DataFrame, batch_size: int) -> DataFrame:
    """Add ``batch_id``: consecutive groups of ``batch_size`` rows in input order."""
    ranked = dense_index(df, [S.ROW_INDEX], "_rank")
    return ranked.withColumn("batch_id", F.floor((F.col("_rank") - 1) / batch_size)).drop("_rank")


def annotate_batches(
    df: DataFrame,
    make_captioner: Callable,
    model_name: str = S.DEFAULT_CAPTION_MODEL,
    batch_size: int = 4,
    payload: str = "image_path",
    load: Callable[[Any], Any] = read_file,
) -> DataFrame:
    """``row_idx`` and the annotation columns, one row per input row.

    Batches are fixed by input order, not by partitions, because a failing batch fails as a
    whole. Rows of a batch are brought together and batches run one after another inside a
    task. The captioner is made once per Python worker. ``load`` opens the value of ``payload``,
    which travels through two shuffles and should be short: a path, not pixels.
    """
    narrow = df.select(
        S.ROW_INDEX, "sample_id", F.col("image_path").alias("path"),
        F.col(payload).alias("payload"),
    )
    batched = number_batches(narrow, batch_size)
    model = per_worker(make_captioner)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        captioner, open_batch = model(), None
        for frame in frames:
            if open_batch is not None:
                frame = pd.concat([open_batch, frame], ignore_index=True)
            if frame.empty:
                continue
            unfinished = frame["batch_id"] == frame["batch_id"].iloc[-1]
            open_batch = frame[unfinished]
            yield from _annotate_frame(frame[~unfinished], captioner)
        if open_batch is not None:
            yield from _annotate_frame(open_batch, captioner)

    def _annotate_frame(frame: pd.DataFrame, captioner) -> Iterator[pd.DataFrame]:
        records = []
        for _, batch in frame.groupby("batch_id", sort=False):
            rows = list(zip(batch["sample_id"], batch["path"], batch["payload"]))
            results = caption_batch(rows, captioner, model_name, load)
            records += [{"row_idx": i, **r} for i, r in zip(batch["row_idx"], results)]
        if records:
            yield pd.DataFrame(records, columns=["row_idx", *_COLUMNS])

    whole = batched.repartition("batch_id").sortWithinPartitions("batch_id", S.ROW_INDEX)
    return whole.mapInPandas(run, LAYOUT)


def annotate_each(
    df: DataFrame,
    make_captioner: Callable,
    model_name: str = S.DEFAULT_CAPTION_MODEL,
    payload: str = "image_path",
    load: Callable[[Any], Any] = read_file,
    path_required: str | None = None,
) -> DataFrame:
    """Every row a batch of its own: no numbering and no shuffle, so it works on a stream.

    With ``path_required`` a row without an image path fails with that message and no model.
    """

    def annotate(row: tuple, captioner) -> dict:
        if path_required is not None and not row[1]:
            return {"sample_id": row[0], "status": S.FAILED, "error": path_required}
        return caption_batch([row], captioner, model_name, load)[0]

    model = per_worker(make_captioner)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        captioner = model()
        for frame in frames:
            rows = zip(frame["sample_id"], frame["path"], frame["payload"])
            records = [annotate(row, captioner) for row in rows]
            yield pd.DataFrame(records, columns=_COLUMNS, dtype=object)

    layout = ", ".join(f"{c} string" for c in _COLUMNS)
    return df.select(
        "sample_id", F.col("image_path").alias("path"), F.col(payload).alias("payload")
    ).mapInPandas(run, layout)


def batch_sizes(df: DataFrame) -> DataFrame:
    return df.groupBy("batch_id").agg(
        F.count(F.lit(1)).alias("rows"), F.min(S.ROW_INDEX).alias("first_row"),
        F.max(S.ROW_INDEX).alias("last_row"),
    )
