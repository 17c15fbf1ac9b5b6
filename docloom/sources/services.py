"""Remote calls as injected callables: fetching and vectors.

Nothing here opens a connection by itself.  A deployment passes a function that does; tests
pass a local one.  Work is spread by host and salt, so one large host does not fill one task.
"""

from __future__ import annotations

import hashlib
import time
from collections.abc import Callable, Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor
from itertools import islice

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom import constants as K
from docloom.functions.text import col
from docloom.functions.urls import host

FETCHED = "url string, effective_url string, http_status int, content_type string, body binary, error string, attempts int"


def is_transient(status, error) -> Column:
    return ((col(status) == 0) & col(error).isNotNull()) | col(status).isin(K.TRANSIENT_HTTP)


def backoff_ms(delay_ms, attempt) -> Column:
    """Delay before the next try: doubles with each attempt."""
    return (col(delay_ms) * F.pow(F.lit(2.0), col(attempt) - 1)).cast("long")


def _transient(status: int, error) -> bool:
    return (status == 0 and error is not None) or status in K.TRANSIENT_HTTP


def call_with_retry(call: Callable, argument, retries: int, delay_ms: int) -> tuple[dict, int]:
    answer: dict = {}
    for attempt in range(1, retries + 1):
        answer = call(argument)
        if not _transient(answer.get("http_status", 0), answer.get("error")):
            return answer, attempt
        if attempt < retries and delay_ms > 0:
            time.sleep(delay_ms * 2 ** (attempt - 1) / 1000)
    return answer, retries


def fetch(
    urls: DataFrame,
    url: str,
    get: Callable[[str], dict],
    concurrency: int = 5,
    retries: int = 3,
    delay_ms: int = 0,
    salts: int = 16,
) -> DataFrame:
    """One row per URL.  ``get(url)`` answers a dict with the FETCHED fields it knows.

    Each task keeps ``concurrency`` requests in flight over its batch, in input order.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        with ThreadPoolExecutor(concurrency) as pool:
            for b in batches:
                answers = pool.map(lambda u: call_with_retry(get, u, retries, delay_ms), b["url"])
                rows = []
                for u, (a, n) in zip(b["url"], answers):
                    rows.append(
                        (u, a.get("effective_url", u), a.get("http_status", 0), a.get("content_type"),
                         a.get("body"), a.get("error"), n)
                    )
                yield pd.DataFrame(
                    rows,
                    columns=["url", "effective_url", "http_status", "content_type", "body", "error", "attempts"],
                )

    spread = urls.select(F.col(url).alias("url")).repartition(
        host("url"), F.pmod(F.xxhash64("url"), F.lit(salts))
    )
    return spread.mapInPandas(run, FETCHED)


def hash_vectors(texts: list[str], dimension: int = 64) -> list[list[float]]:
    """Deterministic stand-in for an embedding model: bytes of a digest, scaled to [-1, 1]."""
    out = []
    for t in texts:
        raw = hashlib.shake_256(t.encode()).digest(dimension)
        out.append([b / 127.5 - 1.0 for b in raw])
    return out


#: Vectors that leave a worker at a time.
ANSWER_ROWS = 512


def add_vectors(
    chunks: DataFrame,
    text: str,
    model: Callable[[list[str]], list[list[float]]] = hash_vectors,
    max_items: int = K.BATCH_MAX_CHUNKS,
    max_chars: int = K.BATCH_MAX_CHARS,
) -> DataFrame:
    """Add ``embedding``; requests hold at most ``max_items`` texts and ``max_chars`` characters.

    A request whose answer has another length gives NULL vectors, not shifted ones.
    """

    def requests(texts: Iterable[str]) -> Iterator[list[str]]:
        batch: list[str] = []
        size = 0
        for t in texts:
            if batch and (len(batch) >= max_items or size + len(t) > max_chars):
                yield batch
                batch, size = [], 0
            batch.append(t)
            size += len(t)
        if batch:
            yield batch

    def embedded(texts: Iterator[str]) -> Iterator[list[float] | None]:
        for batch in requests(texts):
            answer = model(batch)
            yield from answer if len(answer) == len(batch) else [None] * len(batch)

    # requests run over the whole of a batch; their answers leave the worker a few hundred at a time
    @F.arrow_udf("array<double>")
    def vectors(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for b in batches:
            answers = embedded(v.as_py() or "" for v in b)
            while part := list(islice(answers, ANSWER_ROWS)):
                yield pa.array(part, pa.list_(pa.float64()))

    return chunks.withColumn("embedding", vectors(text))
