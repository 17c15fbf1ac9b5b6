"""Exact and near-duplicate detection in arrival order, per site."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom import constants as K
from docloom.functions.ids import content_sha1
from docloom.functions.text import col
from docloom.operators.skew import running_row_number, top_per_key
from docloom.session import checkpoint, forget, short_shuffles, stored


def content_tokens(markdown, limit: int | None = None) -> Column:
    """Distinct words of three or more characters, link addresses ignored; the first ``limit`` if given."""
    t = F.regexp_replace(col(markdown), r"!?\[([^\]]*)\]\([^)]*\)", "$1")
    words = F.split(F.lower(t), r"[^\p{L}\p{N}]+")
    distinct = F.array_distinct(F.filter(words, lambda w: F.length(w) >= 3))
    return distinct if limit is None else F.slice(distinct, 1, limit)


def first_copies(docs: DataFrame, site: str, seq: str, markdown: str) -> DataFrame:
    """(site, fingerprint, first_seq, copies): where each distinct text first arrived.

    Only min and count leave a map task, so a text that fills a third of the corpus costs
    one row per task.
    """
    return docs.groupBy(F.col(site).alias(site), content_sha1(markdown).alias("fingerprint")).agg(
        F.min(seq).alias("first_seq"), F.count("*").alias("copies")
    )


_MARK = [f"m{i}" for i in range(4)]  # a set's mark: 256 bits, each the parity of the words that fall on it
_SET = "words string, n int, " + ", ".join(f"{m} long" for m in _MARK)
_OUT = (
    "site string, seg int, seq long, url string, fp string, accepted boolean, jenis string, "
    f"url_pertama string, skor double, pos int, {_SET}"
)
_STATE = f"site string, seg int, pos int, url string, fp string, {_SET}"


def set_marks(h: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The marks of sets of word hashes that lie one after another in ``h``: a row of four numbers for each."""
    row = np.repeat(np.arange(len(sizes)), sizes)
    parity = np.bincount(row * 256 + ((h >> 24) & 255), minlength=len(sizes) * 256) & 1
    return np.packbits(parity.astype(np.uint8)).view(np.int64).reshape(-1, 4)


def first_words(h: np.ndarray, sizes: np.ndarray, often: np.ndarray, threshold: float) -> np.ndarray:
    """Places in ``h`` of each set's prefix, in the order of ``often`` and the hash: similar sets share one of these words."""
    row = np.repeat(np.arange(len(sizes)), sizes)
    order = np.lexsort((h, often, row))
    place = np.arange(len(h)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    keep = np.minimum(sizes - np.ceil(threshold * sizes - 1e-9).astype(np.int64) + 1, sizes)
    return order[place < keep[row]]


def may_be_similar(n: int, mark: np.ndarray, sizes: np.ndarray, marks: np.ndarray, threshold: float) -> np.ndarray:
    """Which of many sets can be similar to one, by size and mark: no similar one is left out.  Marks are unsigned.

    Each word in which two sets differ turns one bit of their marks.
    """
    near = (sizes >= threshold * n - 1e-9) & (n >= threshold * sizes - 1e-9)
    apart = np.bitwise_count(marks ^ mark).sum(axis=1, dtype=np.int64)
    return near & (apart <= (sizes + n) * ((1 - threshold) / (1 + threshold)) + 1e-9)


def with_marks(docs: DataFrame, rows: int = 2000) -> DataFrame:
    """``docs`` (..., tokens) with the words in one string, their number and their mark in place of ``tokens``."""
    rest = [c for c in docs.columns if c != "tokens"]
    hashes = F.transform("tokens", lambda t: F.xxhash64(t)).alias("h")
    d = docs.withColumn("tokens", F.coalesce("tokens", F.array().cast("array<string>")))
    d = d.select(*rest, F.array_join("tokens", " ").alias("words"), F.size("tokens").alias("n"), hashes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, rows):
                b = whole.slice(at, rows)
                h = b.column(b.num_columns - 1)
                marks = set_marks(h.flatten().to_numpy(), h.value_lengths().to_numpy().astype(np.int64))
                columns = b.columns[:-1] + [pa.array(m) for m in marks.T.copy()]
                yield pa.RecordBatch.from_arrays(columns, names=b.schema.names[:-1] + _MARK)

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in d.schema if f.name != "h")
    return d.mapInArrow(run, schema + "".join(f", {m} long" for m in _MARK))


def _scan_segment(threshold: float, history: int):
    """One segment of at most a few thousand documents, in arrival order.

    The second input holds the fingerprints accepted just before the segment (``pos`` >= 0)
    and the texts of this segment that were accepted in earlier ones (``pos`` = -1).
    A document is held against the sizes and marks of the last ``history`` accepted ones at once; only the words
    of those that can be similar are compared.
    """

    def scan(docs: pd.DataFrame, state: pd.DataFrame) -> pd.DataFrame:
        docs = docs.sort_values("seq")
        seen = dict(zip(state.loc[state.pos < 0, "fp"], state.loc[state.pos < 0, "url"]))
        past = state[state.pos >= 0].sort_values("pos")
        urls, texts, end = list(past.url), list(past.words), len(past)
        both = pd.concat([past[["n", *_MARK]], docs[["n", *_MARK]]])
        # sizes and marks of accepted documents fill these from the front, and never pass the document at hand
        sizes, marks = both.n.to_numpy(np.int64), both[_MARK].to_numpy(np.int64).view(np.uint64)
        rows = []
        for at, d in enumerate(docs.itertuples(index=False), len(past)):
            n, mark = int(sizes[at]), marks[at].copy()
            first, best, kind = None if d.fp is None else seen.get(d.fp), 0.0, None
            if first is not None:
                kind = "identik" if first != d.url else None
                best = 1.0
            elif n and threshold < 1.0:
                begin = max(end - history, 0)
                near = np.flatnonzero(may_be_similar(n, mark, sizes[begin:end], marks[begin:end], threshold)) + begin
                tokens = set(d.words.split(" ")) if len(near) else set()
                for k in near.tolist():
                    other = set(texts[k].split(" "))
                    common = len(tokens & other)
                    score = common / (len(tokens) + len(other) - common)
                    if score > best:
                        best, first = score, urls[k]
                kind = "mirip" if first is not None and best >= threshold else None
            if kind is None:
                seen[d.fp] = d.url
                if n:
                    sizes[end], marks[end] = n, mark
                    urls.append(d.url)
                    texts.append(d.words)
                    end += 1
                rows.append((d.seq, d.url, d.fp, True, None, None, None, None, None, None, *[None] * 4))
            else:
                score = math.floor(best * 10000 + 0.5) / 10000
                rows.append((d.seq, d.url, d.fp, False, kind, first, score, None, None, None, *[None] * 4))
        signed, begin = marks.view(np.int64), max(end - history, 0)
        rows += [
            (None, urls[k], None, None, None, None, None, k - begin, texts[k], int(sizes[k]), *signed[k].tolist())
            for k in range(begin, end)
        ]
        names = ["seq", "url", "fp", "accepted", "jenis", "url_pertama", "skor", "pos", "words", "n", *_MARK]
        # whole numbers as objects first: marks have more digits than a double
        out = pd.DataFrame(rows, columns=names, dtype=object)
        out = out.astype({"skor": "float64", **{c: "Int64" for c in ("seq", "pos", "n", *_MARK)}})
        out.insert(0, "seg", docs.seg.iloc[0])
        out.insert(0, "site", docs.site.iloc[0])
        return out

    return scan


def _inputs_changed(now: DataFrame, used: DataFrame | None) -> DataFrame:
    """Segments whose incoming rows differ from those the last scan used."""
    def sign(df):
        row = F.xxhash64("pos", "url", "fp")
        return df.groupBy("site", "seg").agg(
            F.bit_xor(row).alias("h"), F.count("*").alias("n")
        )

    if used is None:
        return sign(now).select("site", "seg")
    a, b = sign(now).alias("a"), sign(used).alias("b")
    j = a.join(b, ["site", "seg"], "full_outer")
    return j.filter(~F.col("a.h").eqNullSafe(F.col("b.h")) | ~F.col("a.n").eqNullSafe(F.col("b.n"))).select(
        "site", "seg"
    )


def greedy_duplicates(
    docs: DataFrame,
    site: str,
    seq: str,
    url: str,
    markdown: str,
    threshold: float = K.DUPLICATE_SIMILARITY,
    history: int = K.FINGERPRINT_HISTORY,
    segment_rows: int = 5000,
    tokens: int | None = K.FINGERPRINT_TOKENS,
) -> DataFrame:
    """Arrival-ordered duplicate decision with a short memory (``history`` documents, ``tokens`` words).

    The compatible form; ``all_duplicates`` has no limits.

    A document is dropped when its text equals that of an accepted document at another
    address, or when its words are similar to one of the last ``history`` accepted documents
    of the site; only accepted documents are compared against.

    The rule is sequential, the work is not.  Each site's arrival order is cut into bounded
    segments and all segments are scanned at once with a guess of what came before (nothing).
    Then every segment whose true incoming state differs from the one it used is scanned
    again, until none differs.  The first segment is right from the start and a segment is
    right once its predecessor is, so the final state is exactly the sequential result.  A
    window of ``history`` documents forgets quickly, so two or three rounds are the rule.
    A hot site only means more segments; no task ever holds more than one of them.
    """
    d = docs.select(
        F.col(site).cast("string").alias("site"),
        F.col(seq).cast("long").alias("seq"),
        F.col(url).alias("url"),
        content_sha1(markdown).alias("fp"),
        content_tokens(markdown, tokens).alias("tokens"),
    )
    d = with_marks(d)
    # segments are ranks: the row number of a site's arrivals, so their number is no number of partitions
    d = running_row_number(d, ["site"], [F.col("seq")], "rank")
    d = stored(d.withColumn("seg", F.floor((F.col("rank") - 1) / segment_rows).cast("int")).drop("rank"), "duplicates-input")
    segs = d.groupBy("site").agg(F.max("seg").alias("most"))
    segs = checkpoint(segs.select("site", F.explode(F.sequence(F.lit(0), F.col("most"))).alias("seg"), "most"))
    segs = segs.select("site", "seg", F.when(F.col("seg") < F.col("most"), F.col("seg") + 1).alias("next"))
    texts = d.select("site", "seg", "fp").distinct()
    spark = docs.sparkSession
    state = spark.createDataFrame([], _STATE)
    result, used, todo, rounds = None, None, segs.select("site", "seg"), 0
    scan = _scan_segment(threshold, history)
    while True:
        part = d.join(todo, ["site", "seg"], "left_semi")
        incoming = state.join(todo, ["site", "seg"], "left_semi")
        fresh = (
            part.groupBy("site", "seg").cogroup(incoming.groupBy("site", "seg")).applyInPandas(scan, _OUT)
        )
        # only scanned segments are written; earlier rounds stay where they are
        fresh = checkpoint(fresh)
        result = fresh if result is None else result.join(todo, ["site", "seg"], "left_anti").unionByName(fresh)
        used, rounds = state, rounds + 1
        if rounds % 8 == 0:
            result = checkpoint(result)
        # what each segment should have seen: its predecessor's fingerprints ...
        handed = result.filter(F.col("pos").isNotNull()).join(
            segs.filter(F.col("next").isNotNull()), ["site", "seg"]
        )
        handed = handed.select("site", F.col("next").alias("seg"), "pos", "url", "fp", "words", "n", *_MARK)
        # ... and its texts that an earlier segment accepted first
        first = (
            result.filter("accepted")
            .groupBy("site", "fp")
            .agg(F.min_by(F.struct("url", "seg"), "seq").alias("f"))
        )
        prior = texts.join(first, ["site", "fp"]).filter(F.col("f.seg") < F.col("seg"))
        prior = prior.select(
            "site", "seg", F.lit(-1).alias("pos"), F.col("f.url").alias("url"), "fp",
            F.lit("").alias("words"), F.lit(0).alias("n"),
            *[F.lit(0).cast("long").alias(m) for m in _MARK],  # a null would make doubles of the column
        )
        state = checkpoint(handed.unionByName(prior))
        todo = checkpoint(_inputs_changed(state, used))
        if todo.isEmpty():
            break
    return result.filter(F.col("accepted").isNotNull()).select(
        F.col("site").alias(site), F.col("seq").alias(seq), "url", "accepted", "jenis", "url_pertama", "skor"
    )


#: Counters of words by hash.  Words that share a counter share its count: that shifts an order, never a result.
_SLOTS = 1 << 20


def _slot_counts(words: DataFrame) -> np.ndarray:
    """How many rows of ``words`` (h) fall on each counter; what reaches the driver is bounded, however many words there are."""
    found = words.groupBy(F.pmod("h", F.lit(_SLOTS)).alias("slot")).agg(F.count("*").alias("n")).toArrow()
    counts = np.zeros(_SLOTS, np.int64)
    counts[found.column("slot").to_numpy()] = found.column("n").to_numpy()
    return counts


def _prefixes(shared, threshold: float, rows: int = 2000):
    """Keys and mark of each set of word hashes; sets without a key give no row."""

    def some(b: pa.RecordBatch) -> pa.RecordBatch:
        words = b.column(2)
        h, sizes = words.flatten().to_numpy(), words.value_lengths().to_numpy().astype(np.int64)
        row, marks = np.repeat(np.arange(len(sizes)), sizes), set_marks(h, sizes)
        often = shared.value[h % _SLOTS]
        used = first_words(h, sizes, often, threshold)
        used = used[often[used] > 1]  # a word that no other set holds brings nothing together
        held = np.bincount(row[used], minlength=len(sizes))
        ends = np.concatenate(([0], np.cumsum(held))).astype(np.int32)
        out = [b.column(0), b.column(1), pa.array(sizes.astype(np.int32)), pa.ListArray.from_arrays(ends, pa.array(h[used], pa.int64()))]
        out = pa.RecordBatch.from_arrays([*out, *(pa.array(m) for m in marks.T.copy())], names=["site", "node", "n", "keys", *_MARK])
        return out.filter(pa.array(held > 0))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, rows):
                yield some(b.slice(at, rows))

    return run


def _sharing(rows: DataFrame, others: DataFrame, *key: str) -> DataFrame:
    """``rows`` without most of those whose ``key`` (site and word if none is named) no row of ``others`` has: a bounded filter ahead of a join."""
    h = F.xxhash64(*(key or ("site", "t")))
    held = rows.sparkSession.sparkContext.broadcast(_slot_counts(others.select(h.alias("h"))) > 0)

    @F.pandas_udf("boolean")
    def is_held(h: pd.Series) -> pd.Series:
        return pd.Series(held.value[h.to_numpy() % _SLOTS])

    return rows.filter(is_held(h))


def prefix_rows(texts: DataFrame, threshold: float, names: DataFrame | None = None) -> DataFrame:
    """(site, t, node, n, marks, under): a row for each word (its hash) under which a node of ``texts`` (site, node, tokens) can meet similar ones.

    Prefix filter over words ordered rarest first: similar sets share one of their first
    ``n - ceil(threshold n) + 1`` words, so common words never become join keys.  Words that stand alone in the
    prefixes of their site are left out.  ``under`` is at least the number of rows with the row's site and word.
    With ``names`` (row, node) the texts are told by ``node`` as a row; those named there get that node, the others no rows:
    sets of words need not travel for it.
    """
    context = texts.sparkSession.sparkContext
    words = texts.select("site", "node", F.transform("tokens", lambda t: F.xxhash64(t)).alias("h"))
    # without a site or a number a text equals no other's: it meets nothing, and joins would never take it out
    words = words.filter((F.size("h") > 0) & F.col("site").isNotNull() & F.col("node").isNotNull())
    shared = context.broadcast(_slot_counts(words.select(F.explode("h").alias("h"))))
    marks = ", ".join(f"{m} long" for m in _MARK)
    rows = words.mapInArrow(_prefixes(shared, threshold), f"site string, node long, n int, keys array<long>, {marks}")
    if names is not None:
        rows = rows.withColumnRenamed("node", "row").join(names.filter(F.col("node").isNotNull()).select("row", "node"), "row").drop("row")
    rows = stored(rows, "duplicates-keys")
    key = F.xxhash64("site", "t")
    meets = context.broadcast(_slot_counts(rows.select("site", F.explode("keys").alias("t")).select(key.alias("h"))).astype(np.int32))

    @F.pandas_udf("int")
    def rows_under(h: pd.Series) -> pd.Series:
        return pd.Series(meets.value[h.to_numpy() % _SLOTS])

    out = rows.select("site", F.explode("keys").alias("t"), "node", "n", *_MARK)
    out = stored(out.withColumn("under", rows_under(key)).filter(F.col("under") > 1), "duplicates-prefixes")
    forget(rows)
    return out


def _similar(
    left: DataFrame, right: DataFrame, sets: Callable[[DataFrame], DataFrame], threshold: float, earlier: bool = True,
    missing: DataFrame | None = None,
) -> DataFrame:
    """(site, a, b, score): nodes of two sets of prefix rows that are similar; ``earlier``: only pairs with a < b.

    Each word in which two sets differ turns one bit of their marks, so marks too far apart tell that sets are not
    similar.  Sets with k words in common have as many words of their prefixes in common as k exceeds
    ``ceil(threshold n) - 1``, n the larger size; pairs that met under fewer go.  ``missing`` (site, node, words) says
    how many words' rows of a node b are not in ``right`` though the pair's a may have them in ``left``.
    Pairs travel as numbers; only the sets of what is left are read (``sets``: words of (site, node)) to verify it.
    """
    a, b = left.alias("a"), right.alias("b")
    na, nb = F.col("a.n"), F.col("b.n")
    near = (na >= threshold * nb - 1e-9) & (nb >= threshold * na - 1e-9)
    order = F.col("a.node") < F.col("b.node") if earlier else F.col("a.node") != F.col("b.node")
    apart = reduce(lambda x, y: x + y, (F.bit_count(F.col(f"a.{m}").bitwiseXOR(F.col(f"b.{m}"))) for m in _MARK))
    close = apart <= (na + nb) * ((1 - threshold) / (1 + threshold)) + 1e-9
    need = F.ceil((na + nb) * (threshold / (1 + threshold)) - 1e-9) - F.ceil(threshold * F.greatest(na, nb) - 1e-9) + 1
    met = a.join(b, (F.col("a.site") == F.col("b.site")) & (F.col("a.t") == F.col("b.t")) & order & near & close)
    met = met.select(F.col("a.site").alias("site"), F.col("a.node").alias("a"), F.col("b.node").alias("b"), need.alias("need"))
    met = met.groupBy("site", "a", "b").agg(F.count("*").alias("c"), F.min("need").alias("need"))
    if missing is not None:
        met = met.join(missing.withColumnRenamed("node", "b"), ["site", "b"], "left").withColumn("c", F.col("c") + F.coalesce("words", F.lit(0)))
    met = stored(met.filter("c >= need").select("site", "a", "b"), "duplicates-pairs")
    if met.isEmpty():
        return met.withColumn("score", F.lit(0.0))
    ends = stored(met.select("site", F.explode(F.array("a", "b")).alias("node")).distinct(), "duplicates-ends")
    few = stored(sets(ends), "duplicates-sets", "zstd")
    met = met.join(few.select("site", F.col("node").alias("a"), F.col("words").alias("wa")), ["site", "a"])
    met = met.join(few.select("site", F.col("node").alias("b"), F.col("words").alias("wb")), ["site", "b"])
    met = met.select("site", "a", "b", F.split("wa", " ").alias("ta"), F.split("wb", " ").alias("tb"))
    common = F.size(F.array_intersect("ta", "tb"))
    score = common / (F.size("ta") + F.size("tb") - common)
    return met.select("site", "a", "b", score.alias("score")).filter((F.col("score") >= threshold) & (F.col("score") > 0))


def _settled(edges: DataFrame, ready: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(accepted, dropped) nodes (site, node) that the edges (site, a, b) among open nodes decide.

    ``ready`` nodes know all their earlier neighbours.  A ready node is accepted once all earlier
    neighbours are dropped, and a node is dropped once one is accepted; round by round, open edges only.
    """
    open_edges = edges.select("site", "a", "b")
    accepted = dropped = None
    waiting = ready
    while True:
        later = open_edges.select("site", F.col("b").alias("node")).distinct()
        free = checkpoint(waiting.join(later, ["site", "node"], "left_anti"))
        accepted = free if accepted is None else accepted.unionByName(free)
        own = free.withColumnRenamed("node", "a")
        gone = checkpoint(open_edges.join(own, ["site", "a"], "left_semi").select("site", F.col("b").alias("node")).distinct())
        dropped = gone if dropped is None else dropped.unionByName(gone)
        if gone.isEmpty():
            return checkpoint(accepted), checkpoint(dropped)
        waiting = checkpoint(waiting.join(free, ["site", "node"], "left_anti").join(gone, ["site", "node"], "left_anti"))
        rest = open_edges.join(own, ["site", "a"], "left_anti")
        rest = rest.join(gone.withColumnRenamed("node", "b"), ["site", "b"], "left_anti")
        open_edges = checkpoint(rest.join(gone.withColumnRenamed("node", "a"), ["site", "a"], "left_anti"))


def greedy_representatives(
    prefixes: DataFrame, sets: Callable[[DataFrame], DataFrame], threshold: float, leaders: int = 256, most_leaders: int = 4096
) -> DataFrame:
    """Arrival-ordered choice: the nodes (site, node) that are similar to an accepted earlier node.

    ``prefixes`` comes from ``prefix_rows``, ``sets`` gives (site, node, words) for nodes (site, node).  Under each prefix word only
    the first ``leaders`` open nodes are compared with one another.  A node that is a leader under all its words knows
    all its earlier neighbours and can be decided.  Only what was newly accepted is then compared with the rest
    of its words' nodes, and what is similar is dropped.  So a site of near copies costs a comparison with its
    representatives, never all its pairs.  Where the nodes under a hot word are all different, more leaders are
    taken each round (up to ``most_leaders``).  Words with few rows are not ranked: all their nodes are leaders.
    """
    todo, names, all_dropped = prefixes, ["site", "node"], []
    while True:
        hot = todo.filter(F.col("under") > leaders)
        first, rest = todo.filter(F.col("under") <= leaders), None
        if not hot.isEmpty():
            top = stored(top_per_key(hot, ["site", "t"], [F.col("node")], leaders).drop("rn"), "duplicates-leaders")
            rest = hot.join(top.select("site", "t", "node"), ["site", "t", "node"], "left_anti")
            rest = stored(rest.groupBy(*names).agg(F.count("*").alias("words")), "duplicates-rest")
            first = first.unionByName(top)
            rest = None if rest.isEmpty() else rest
        nodes = todo.select(*names).distinct()
        ready = nodes if rest is None else nodes.join(rest, names, "left_anti")
        edges = checkpoint(_similar(first, first, sets, threshold, missing=rest))
        accepted, dropped = _settled(edges, checkpoint(ready))
        if rest is None:
            return reduce(DataFrame.unionByName, [*all_dropped, dropped])
        # the nodes of the rest meet what was accepted under all their words
        accepted = stored(accepted, "duplicates-accepted")
        behind = stored(rest.select(*names).join(dropped, names, "left_anti"), "duplicates-behind")
        if not behind.isEmpty():
            right = stored(todo.join(behind, names, "left_semi"), "duplicates-behind-prefixes")
            left = _sharing(first, right).join(accepted, names, "left_semi")
            more = _similar(left, right, sets, threshold)
            dropped = checkpoint(dropped.unionByName(more.select("site", F.col("b").alias("node"))).distinct())
        all_dropped.append(dropped)
        # read and broadcast where few are open, so that the rows of the others stay where they are
        open_nodes = stored(nodes.join(accepted, names, "left_anti").join(dropped, names, "left_anti"), "duplicates-open")
        if open_nodes.isEmpty():
            return reduce(DataFrame.unionByName, all_dropped)
        todo = stored(todo.join(open_nodes, names, "left_semi"), "duplicates-prefixes")
        leaders = min(2 * leaders, most_leaders)


def all_duplicates(
    docs: DataFrame, site: str, seq: str, url: str, markdown: str, threshold: float = K.DUPLICATE_SIMILARITY
) -> DataFrame:
    """Arrival-ordered duplicate decision over whole texts and all earlier documents of a site.

    The rule of ``greedy_duplicates`` without its limits.  Equal texts are one node, named by its first
    arrival; ``greedy_representatives`` decides which nodes stay.  The address and score shown for a dropped document are
    those of the most similar accepted one before it, the earlier of equals: a minimum, not a list.

    Sets of words are written once, with the row they belong to, and stay there: what travels are keys and numbers of rows,
    and the sets of those few pairs that are verified.
    """
    with short_shuffles(docs.sparkSession):
        return _all_duplicates(docs, site, seq, url, markdown, threshold)


def _all_duplicates(docs: DataFrame, site: str, seq: str, url: str, markdown: str, threshold: float) -> DataFrame:
    d = docs.select(
        F.col(site).cast("string").alias("site"), F.col(seq).cast("long").alias("seq"), F.col(url).alias("url"),
        content_sha1(markdown).alias("fp"), F.array_join(content_tokens(markdown), " ").alias("words"),
        F.monotonically_increasing_id().alias("row"),
    )
    d = stored(d, "duplicates-input", "zstd")
    names = ["site", "node"]
    texts = stored(
        d.groupBy("site", "fp").agg(
            F.min("seq").alias("node"), F.min_by("url", "seq").alias("first_url"), F.min("row").alias("row")),
        "duplicates-texts")

    def sets(nodes: DataFrame) -> DataFrame:
        rows = stored(texts.join(nodes, names, "left_semi").select("row", *names), "duplicates-rows")
        return _sharing(d.select("row", "words"), rows, "row").join(rows, "row").select(*names, "words")

    words = F.when(F.col("words") != "", F.split("words", " "))
    prefixes = prefix_rows(d.select("site", F.col("row").alias("node"), words.alias("tokens")), threshold, texts)
    dropped = greedy_representatives(prefixes, sets, threshold) if threshold < 1.0 else texts.select(*names).limit(0)
    dropped = dropped.withColumn("gone", F.lit(True))
    nodes = stored(
        texts.join(dropped, names, "left").select(*names, "fp", "first_url", F.coalesce("gone", F.lit(False)).alias("gone")), "duplicates-nodes")
    # dropped texts next to all accepted ones they are similar to; later copies also see what was accepted after the first
    gone_nodes = stored(nodes.filter("gone").select(*names), "duplicates-gone")
    gone = stored(prefixes.join(gone_nodes, names, "left_semi"), "duplicates-gone-prefixes")
    stay = _sharing(prefixes, gone).join(gone_nodes, names, "left_anti")
    links = _similar(stay, gone, sets, threshold, earlier=False)
    kept = nodes.filter(~F.col("gone")).select("site", F.col("node").alias("a"), F.col("first_url").alias("a_url"))
    near = links.join(kept, ["site", "a"]).select("site", F.col("b").alias("node"), "a", "a_url", "score")
    early = d.select("site", "seq", "fp").join(nodes.filter("gone").select("site", "fp", "node"), ["site", "fp"])
    best = early.join(near, names).filter(F.col("a") < F.col("seq")).groupBy("site", "seq").agg(
        F.min(F.struct((-F.col("score")).alias("s"), "a", "a_url")).alias("best"))
    out = d.drop("words", "row").join(nodes, ["site", "fp"]).join(best, ["site", "seq"], "left")
    same = ~F.col("gone") & (F.col("url") != F.col("first_url"))
    score = F.when(same, F.lit(1.0)).when(F.col("gone"), F.floor(-F.col("best.s") * 10000 + 0.5) / 10000)
    return stored(out.select(
        F.col("site").alias(site), F.col("seq").alias(seq), "url", (~F.col("gone") & ~same).alias("accepted"),
        F.when(same, F.lit("identik")).when(F.col("gone"), F.lit("mirip")).alias("jenis"),
        F.when(same, F.col("first_url")).when(F.col("gone"), F.col("best.a_url")).alias("url_pertama"), score.alias("skor"),
    ), "duplicates-found")
