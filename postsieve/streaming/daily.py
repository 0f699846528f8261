"""Container files that arrive day by day, as a file stream."""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from postsieve.functions.headers import sent_timestamp
from postsieve.schemas import MAIL_CONTAINER


#: groups that the keys of a stream are dealt out to; a checkpoint goes with its number
BUCKETS = 1024


def stream_containers(
    spark: SparkSession, root: str, schema: T.StructType = MAIL_CONTAINER,
    files_per_trigger: int = 100,
) -> DataFrame:
    """New container files below ``root``."""
    return (
        spark.readStream.schema(schema)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.parquet")
        .option("maxFilesPerTrigger", files_per_trigger)
        .parquet(root)
    )


def drop_repeats(mails: DataFrame, delay: str | None = None) -> DataFrame:
    """Each message id once.

    Ids stay in the state for good, so no mail is too late.  With ``delay`` the
    state is bounded: ids older than that leave it, and mails dated further
    back than the newest one are dropped.
    """
    if delay is None:
        return mails.dropDuplicates(["message_id"])
    sent = sent_timestamp(mails["date"], mails["time"])
    return (
        mails.withColumn("sent", sent)
        .withWatermark("sent", delay)
        .dropDuplicatesWithinWatermark(["message_id"])
        .drop("sent")
    )


def keep_first_arrival(
    mails: DataFrame, key: str = "message_id", order: tuple[str, ...] = ("file_seq", "row_seq"),
    buckets: int = BUCKETS,
) -> DataFrame:
    """The first row of each key in load order, as the batch build keeps it; null counts as one key.

    Of the rows of one trigger the one that comes first in ``order`` is passed
    on, unless an earlier trigger has passed one.  Agrees with the batch build
    where files arrive in load order.

    A call for every key would cost milliseconds a mail, so keys go by buckets
    of their hash: a call settles all keys of a bucket, and its state is the
    list of those it has passed on, as they are.  The rows of a bucket go by in
    pieces, of which the best row of each key is held.  A stream keeps the
    number of ``buckets`` it began with.
    """
    columns = mails.columns

    def first(keys: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        best = None
        for part in parts:
            rows = part if best is None else pd.concat([best, part])
            best = rows.sort_values(list(order), kind="stable", na_position="first").drop_duplicates(key)
        if best is None:
            return
        passed = pickle.loads(state.get[0]) if state.exists else []
        known = set(passed)
        found = [None if missing else value for value, missing in zip(best[key].tolist(), best[key].isna(), strict=True)]
        new = [value not in known for value in found]
        if any(new):
            passed += [value for value, is_new in zip(found, new, strict=True) if is_new]
            state.update((pickle.dumps(passed),))
            yield best.loc[new, columns]

    bucket = F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")
    return mails.withColumn("__bucket", bucket).groupBy("__bucket").applyInPandasWithState(
        first, mails.schema, "passed binary", "append", GroupStateTimeout.NoTimeout)


def append_new(mails: DataFrame, target: str, checkpoint: str) -> StreamingQuery:
    """Process all files that are there, append to ``target``, then stop."""
    return (
        mails.writeStream.format("parquet")
        .option("path", target)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
