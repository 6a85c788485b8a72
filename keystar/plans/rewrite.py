"""Text rewriting by an external service: requests, calls, parsing, repair."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keystar import constants as K
from keystar.functions.json_text import has_unescaped_quotes, parse_status, parsed_object, string_field
from keystar.functions.texts import prompt
from keystar.plans.marts import ANCHOR
from keystar.session import scratch_path, stash
from keystar.sources.storage import count_rows, exists, read_parquet, swap_in, write_manifest

# Called with a list of prompts, returns one response text (or None) per prompt.
Caller = Callable[[list[str]], list[str | None]]


def source_text(df: DataFrame, text: str = "function_raw") -> DataFrame:
    """The placeholder of the dimension counts as no text."""
    return df.withColumn(text, F.when(F.col(text) != K.NO_INFORMATION, F.col(text)))


def requests(
    source: DataFrame, limit: int | None = None, text: str = "function_raw"
) -> DataFrame:
    """(anchor, function_raw, prompt) per source row; ``limit`` takes the first keys (trial run).

    Feed this from staging: the dimension itself reads the rewrites.
    """
    rows = source_text(source, text).select(
        ANCHOR,
        text,
        prompt(F.col("gene_symbol"), F.col("protein_name"), F.col(text)).alias("prompt"),
    )
    return rows if limit is None else rows.orderBy(ANCHOR).limit(limit)


def call_batches(prompts: DataFrame, caller: Caller, batch: int = 10_000) -> DataFrame:
    """(anchor, response): ``caller`` once per chunk of at most ``batch`` prompts.

    Each evaluation calls the service, so write the result before reading it.
    """

    def call(chunks: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for chunk in chunks:
            for start in range(0, len(chunk), batch):
                part = chunk.iloc[start : start + batch]
                yield pd.DataFrame(
                    {ANCHOR: part[ANCHOR], "response": caller(part["prompt"].tolist())}
                )

    return prompts.select(ANCHOR, "prompt").mapInPandas(call, f"{ANCHOR} string, response string")


def parse_responses(responses: DataFrame) -> DataFrame:
    """(anchor, function_friendly, tagline) from responses, each only if it is a JSON string."""
    return responses.withColumn("_parsed", parsed_object(F.col("response"))).select(
        ANCHOR,
        string_field(F.col("_parsed"), "function_friendly").alias("function_friendly"),
        string_field(F.col("_parsed"), "tagline").alias("tagline"),
    )


def assemble(keys: DataFrame, parsed: DataFrame, model_id: str) -> DataFrame:
    """Rewrites for every key, NULL where nothing was sent or nothing usable came back."""
    return (
        keys.select(ANCHOR)
        .join(parsed, ANCHOR, "left")
        .withColumn("model_id", F.lit(model_id))
        .withColumn("generated_at", F.current_timestamp())
    )


def send(
    wanted: DataFrame,
    caller: Caller,
    path: str,
    model_id: str = "",
    force: bool = False,
    partitions: int | None = None,
    waves: int = 1,
) -> int:
    """Answer the requests that ``path`` does not answer yet; returns how many were sent.

    A manifest names the run before the first call. Requests go out in ``waves`` of keys, each
    written before the next, so a job that fails pays again for its own wave only and the next
    call sends what is missing. ``force`` answers all of them anew and then replaces the old
    answers. ``partitions`` is the number of tasks that call at a time.
    """
    spark = wanted.sparkSession
    path = path.rstrip("/")
    before = count_rows(spark, path) if exists(spark, path) and not force else 0
    target = f"{path}.{uuid.uuid4().hex}" if force else path
    pending = wanted.where(F.col("function_raw").isNotNull()).select(ANCHOR, "prompt")
    if before:
        answered = read_parquet(spark, path).select(ANCHOR)
        pending = pending.join(answered, ANCHOR, "left_anti")
    pending = stash(pending, "requests")
    open_requests = pending.count()
    if not open_requests and before:
        return 0
    write_manifest(
        spark, f"{path}.manifest", model_id=model_id, requests=str(open_requests), force=str(force)
    )
    for wave in range(waves):
        part = pending.where(F.pmod(F.xxhash64(ANCHOR), F.lit(waves)) == wave)
        part = part.repartition(partitions, ANCHOR) if partitions else part
        call_batches(part, caller).write.mode("append").parquet(target)
    if force:
        swap_in(spark, target, path)
    return count_rows(spark, path) - before


def rewrite(
    source: DataFrame,
    caller: Caller,
    model_id: str,
    limit: int | None = None,
    path: str | None = None,
    force: bool = False,
    partitions: int | None = None,
    waves: int = 1,
) -> DataFrame:
    """Rewrites of all source rows; rows without text are not sent.

    The raw responses are written to ``path`` or the scratch folder, so the service is not
    called again when the result is read, nor by a second run with the same ``path``: see
    ``send``. ``rows_to_redo`` can read them there too.
    """
    spark = source.sparkSession
    wanted = requests(source, limit)
    at = path or scratch_path(spark, "responses")
    send(wanted, caller, at, model_id, force, partitions, waves)
    responses = read_parquet(spark, at).join(wanted.select(ANCHOR), ANCHOR, "left_semi")
    return assemble(wanted, parse_responses(responses), model_id)


def rewrite_metrics(rewrites: DataFrame) -> DataFrame:
    return rewrites.agg(
        F.count(F.lit(1)).alias("num_proteins"),
        F.count("function_friendly").alias("num_function_friendly"),
        F.count("tagline").alias("num_taglines"),
    )


def rows_to_redo(rewrites: DataFrame, responses: DataFrame, source: DataFrame) -> DataFrame:
    """Source rows whose rewrite is missing because the response broke on inner quotes.

    A valid response that holds nulls is left alone: the service declined that text.
    """
    missing = rewrites.where(F.col("function_friendly").isNull()).select(ANCHOR)
    text = F.col("response")
    broken = responses.where(
        (parse_status(text) == "malformed") & has_unescaped_quotes(text)
    ).select(ANCHOR)
    substantive = source_text(source).where(F.col("function_raw").isNotNull())
    return substantive.join(missing, ANCHOR, "left_semi").join(broken, ANCHOR, "left_semi")


def build_editorial_seed(matched: DataFrame) -> DataFrame:
    """Curated rows resolved to anchors, in the editorial seed's columns."""
    return matched.select(
        ANCHOR,
        "tagline",
        F.col("text").alias("function_friendly"),
        F.lit(True).alias("is_curated"),
    )
