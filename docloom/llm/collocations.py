"""Phrase collocations by stripes.

A stripe belongs to a prefix and is a counter of what follows it.  Level by level: the prefix is a frequent
phrase of m words at a place, what follows is the frequent phrase of m words one place on, so both together
are one phrase of m + 1 words.  (On level 0 the prefix is the language, what follows a word.)  Stripes of all
blocks of text are merged entry by entry.  One merged structure answers everything:

* extensions: entries of at least ``min_count`` are the frequent phrases one word longer;
* totals: an entry is the frequency of its phrase, the numerator and, for longer ones, the parts of a cut;
* subsumption: the largest entry of a prefix, and of a follower, says whether a longer phrase covers it.

No phrase can be frequent unless both its parts are, so each level looks only at places where two
frequent phrases meet, and nothing is lost.

Scale: a block of text is one row (numbers of the phrase at each place).  A block sends its own stripes; the
stripe of a phrase that occurs more than ``slice`` times is cut into slices by the follower, so a stripe of a
common word lies in many slices and no task holds it whole.  Slices are dealt into buckets, as many as the places of
the table ask for, and the slices of a bucket travel from a block as one compressed row.  Merging reads bucket by
bucket; the merged bucket answers each block that sent to it with the numbers of what is frequent, again one row.
Words are merged like phrases, so nothing is joined back to places.  Nothing is broadcast.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.llm.common import read, stored
from docloom.llm.registry import query
from docloom.operators.skew import top_per_key


@dataclass(frozen=True)
class PhraseOptions:
    """``words``: longest phrase; ``min_count``: least frequency; ``top``: phrases of a language;
    ``block_bytes``: text of a block; ``slice``: occurrences of a slice of a stripe; ``bucket``: places that a bucket
    of slices stands for, about."""

    words: int = 5
    min_count: int = 100
    top: int = 2000
    block_bytes: int = 8 << 20
    slice: int = 1 << 16
    bucket: int = 1 << 20


_CUT = bytes.maketrans(b".,;:!?\x0b\x0c\r\t", b"\n" * 9 + b" ")
NONE = -1  # no frequent phrase starts here, or a piece ends here
BLOCKS = "block long, langs array<string>, totals array<long>, words binary, entries binary, places binary"
FEWEST_BUCKETS, MOST_BUCKETS = 256, 1 << 16


def _new_numbers(first: int, count: np.ndarray, options: PhraseOptions) -> np.ndarray:
    """Numbers for phrases with these counts: the power of two of their slices, then the task, then a running number."""
    power = np.maximum(0, np.ceil(np.log2(np.maximum(count, 1) / options.slice))).astype(np.int64)
    return (power << 56) | np.arange(first, first + len(count))


def _slice_of(prefix: np.ndarray, after: np.ndarray) -> np.ndarray:
    """Slice of a follower in the stripe of a prefix."""
    mixed = after.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return ((mixed >> np.uint64(32)) & ((np.uint64(1) << (prefix >> 56).astype(np.uint64)) - np.uint64(1))).astype(np.int64)


def _packed(*columns: np.ndarray) -> bytes:
    """Whole numbers of equal lengths, compressed byte by byte; the first of several as steps, small ones where it is sorted."""
    x = np.array(columns, np.int64)
    if len(x) > 1:
        x[0] = np.diff(x[0], prepend=0)
    return zlib.compress(x.view(np.uint8).reshape(len(columns), -1, 8).transpose(0, 2, 1).tobytes(), 1)


def _unpacked(x: bytes, columns: int = 1) -> np.ndarray:
    """The columns as rows of one array."""
    planes = np.frombuffer(zlib.decompress(x), np.uint8).reshape(columns, 8, -1)
    out = planes.transpose(0, 2, 1).copy().view(np.int64).reshape(columns, -1)
    if columns > 1:
        out[0] = np.cumsum(out[0])
    return out


def _blocks(block_bytes: int):
    """Documents to blocks: distinct words by language with their counts, and the word number at each place."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        block, size = TaskContext.get().partitionId() << 32, 0
        number: dict[str, dict[bytes, int]] = {}
        places: list[np.ndarray] = []
        known = 0

        def emit():
            at = np.concatenate(places)
            langs = list(number)
            words, lang, ids = [], [], []
            for i, own in enumerate(number.values()):
                words += own
                lang += [i] * len(own)
                ids += own.values()
            order = np.argsort(ids)
            counts = np.bincount(at[at >= 0], minlength=known)
            lang = np.array(lang, np.int32)[order]
            totals = np.bincount(lang, counts, minlength=len(langs)).astype(np.int64)  # a block's counts are exact in a double
            words = [words[i] for i in order.tolist()]
            entries = _packed(lang, counts, np.fromiter(map(len, words), np.int64, len(words)))
            columns = [
                pa.array([block], pa.int64()), pa.array([langs], pa.list_(pa.string())), pa.array([totals], pa.list_(pa.int64())),
                pa.array([zlib.compress(b"".join(words), 1)], pa.binary()), pa.array([entries], pa.binary()), pa.array([_packed(at)], pa.binary()),
            ]
            return pa.RecordBatch.from_arrays(columns, names=["block", "langs", "totals", "words", "entries", "places"])

        for b in batches:
            for lang, text in zip(b.column(0).to_pylist(), b.column(1)):
                raw = text.as_buffer().to_pybytes()
                own = number.setdefault(lang, {b"\n": NONE})
                found = raw.lower().translate(_CUT).replace(b"\n", b" \n ").split(b" ")
                found.append(b"\n")
                ids = []
                for w in found:
                    if w:
                        i = own.get(w)
                        if i is None:
                            i = own[w] = known
                            known += 1
                        ids.append(i)
                places.append(np.array(ids, np.int32))
                size += len(raw)
                if size >= block_bytes:
                    for x in number.values():
                        del x[b"\n"]
                    yield emit()
                    block, size, number, places, known = block + 1, 0, {}, [], 0
        if places:
            for x in number.values():
                del x[b"\n"]
            yield emit()

    return run


WORD_STRIPES = "bucket int, block long, langs array<string>, entries binary, words binary"
STRIPES = "bucket int, block long, entries binary"


def _runs(key: np.ndarray) -> list[tuple[int, int]]:
    """Begin and end of the runs of equal neighbours."""
    edge = np.concatenate([[0], np.flatnonzero(key[1:] != key[:-1]) + 1, [len(key)]]).tolist()
    return list(zip(edge[:-1], edge[1:])) if len(key) else []


def _words(text: bytes, length: np.ndarray) -> pa.LargeBinaryArray:
    """Words that lie one after the other."""
    at = np.concatenate([[0], np.cumsum(length)]).astype(np.int64)
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(length), [None, pa.py_buffer(at), pa.py_buffer(text)])


def _word_stripes(buckets: int):
    """Blocks ``block, langs, words, entries`` to the words of each bucket: number in the block, language, count, length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for block, langs, text, entries in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2), b.column(3)):
                lang, counts, length = _unpacked(entries.as_buffer(), 3)
                if not len(length):
                    continue
                words = _words(zlib.decompress(text.as_buffer()), length)
                bucket = (np.fromiter(map(zlib.crc32, words.to_pylist()), np.int64, len(words)) % buckets).astype(np.uint16)
                own = np.argsort(bucket, kind="stable")
                bucket, lang, counts, length = bucket[own], lang[own], counts[own], length[own]
                at = np.concatenate([[0], np.cumsum(length)]).tolist()
                data = memoryview(b"".join(words.take(pa.array(own)).to_pylist()))
                runs = _runs(bucket)
                columns = [
                    pa.array([bucket[a] for a, _ in runs], pa.int32()), pa.array([block] * len(runs), pa.int64()), pa.array([langs] * len(runs), pa.list_(pa.string())),
                    pa.array([_packed(own[a:z], lang[a:z], counts[a:z], length[a:z]) for a, z in runs], pa.binary()),
                    pa.array([zlib.compress(data[at[a]:at[z]], 1) for a, z in runs], pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["bucket", "block", "langs", "entries", "words"])

    return run


def _stripes(buckets: int):
    """Blocks ``block, places`` (phrase numbers) to their stripes by bucket: prefix, follower, count."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for block, packed in zip(b.column(0).to_pylist(), b.column(1)):
                at = _unpacked(packed.as_buffer())[0]
                ids, code = np.unique(at, return_inverse=True)
                both = (at[:-1] >= 0) & (at[1:] >= 0)
                pair, count = np.unique(code[:-1][both] * len(ids) + code[1:][both], return_counts=True)
                if not len(pair):
                    continue
                prefix, after = ids[pair // len(ids)], ids[pair % len(ids)]
                mixed = (prefix + (_slice_of(prefix, after) << 20)).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
                bucket = ((mixed >> np.uint64(32)) % np.uint64(buckets)).astype(np.uint16)
                by = np.argsort(bucket, kind="stable")
                bucket, prefix, after, count = bucket[by], prefix[by], after[by], count[by]
                runs = _runs(bucket)
                entries = [_packed(prefix[a:z], after[a:z], count[a:z]) for a, z in runs]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([bucket[a] for a, _ in runs], pa.int32()), pa.array([block] * len(runs), pa.int64()), pa.array(entries, pa.binary())],
                    names=["bucket", "block", "entries"])

    return run


def _by_bucket(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
    """Rows of each bucket, from rows sorted by bucket."""
    held: list[tuple] = []
    for b in batches:
        for row in zip(*(c.to_pylist() for c in b.columns)):
            if held and held[-1][0] != row[0]:
                yield held
                held = []
            held.append(row)
    if held:
        yield held


MERGED_WORDS = "block long, entries binary, lang array<string>, word array<binary>, ids array<long>, count array<long>"
MERGED = "block long, entries binary, prefix array<long>, next array<long>, ids array<long>, count array<long>"


def _merging(options: PhraseOptions, names: list[str], kinds: list[pa.DataType], read, found):
    """Stripes sorted by bucket, to a row of the frequent phrases of a bucket (two parts, new number, count; no block)
    and to rows of the blocks that have them.

    ``read``: rows of a bucket to the number of the phrase of each entry, the entry's count and block, the columns that go
    back and something for ``found``, which names the parts of phrases by their first entry.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 40
        for rows in _by_bucket(batches):
            phrase, count, row, back, more = read(rows)
            total = np.zeros(int(phrase.max()) + 1, np.int64)
            np.add.at(total, phrase, count)
            often = total >= options.min_count
            if not often.any():
                continue
            ids = np.full(len(total), NONE, np.int64)
            ids[often] = _new_numbers(number, total[often], options)
            number += int(often.sum())
            first = np.zeros(len(total), np.int64)
            first[phrase[::-1]] = np.arange(len(phrase) - 1, -1, -1)
            mine = np.flatnonzero(often[phrase])  # entries lie block by block
            row, ids_back, back = row[mine], ids[phrase[mine]], [x[mine] for x in back]
            runs = _runs(row)
            packed = [None, *(_packed(*(x[a:z] for x in back), ids_back[a:z]) for a, z in runs)]
            columns = [pa.array([None, *(rows[row[a]][1] for a, _ in runs)], pa.int64()), pa.array(packed, pa.binary())]
            for x, kind in zip([*found(first[often], more), ids[often], total[often]], kinds):
                columns.append(pa.array([x, *[None] * len(runs)], pa.list_(kind)))
            yield pa.RecordBatch.from_arrays(columns, names=["block", "entries", *names])

    return run


def _merged_words(options: PhraseOptions):
    def entries(rows: list[tuple]):
        parts = [_unpacked(r[3], 4) for r in rows]
        langs: dict[str, int] = {}
        lang = np.concatenate([np.array([langs.setdefault(x, len(langs)) for x in r[2]], np.int64)[p[1]] for r, p in zip(rows, parts)])
        own, _, count, length = np.concatenate(parts, axis=1)
        words = _words(b"".join(zlib.decompress(r[4]) for r in rows), length)
        code = words.dictionary_encode().indices.to_numpy().astype(np.int64)
        phrase = np.unique(code * len(langs) + lang, return_inverse=True)[1]
        row = np.repeat(np.arange(len(rows)), [p.shape[1] for p in parts])
        return phrase, count, row, [own], (list(langs), lang, words)

    def found(first: np.ndarray, more):
        langs, lang, words = more
        return [langs[i] for i in lang[first]], words.take(pa.array(first)).to_pylist()

    return _merging(options, ["lang", "word", "ids", "count"], [pa.string(), pa.binary(), pa.int64(), pa.int64()], entries, found)


def _merged(options: PhraseOptions):
    def entries(rows: list[tuple]):
        parts = [_unpacked(r[2], 3) for r in rows]
        prefix, after, count = np.concatenate(parts, axis=1)
        by = np.lexsort((after, prefix))
        new = (np.diff(prefix[by], prepend=NONE) != 0) | (np.diff(after[by], prepend=NONE) != 0)
        phrase = np.empty(len(by), np.int64)
        phrase[by] = np.cumsum(new) - 1
        row = np.repeat(np.arange(len(rows)), [p.shape[1] for p in parts])
        return phrase, count, row, [prefix, after], (prefix, after)

    def found(first: np.ndarray, more):
        return more[0][first], more[1][first]

    return _merging(options, ["prefix", "next", "ids", "count"], [pa.int64()] * 4, entries, found)


def _find(keys: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Places of ``wanted`` in sorted ``keys``, -1 where absent."""
    if not len(keys):
        return np.full(len(wanted), -1)
    i = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[i] == wanted, i, -1)


def _entries(found: pa.Table, columns: int) -> np.ndarray:
    return np.concatenate([np.zeros((columns, 0), np.int64), *(_unpacked(x.as_buffer(), columns) for x in found["entries"])], axis=1)


PLACES = "block long, places binary"


def _place_rows(rows: list[tuple]) -> pa.Table:
    return pa.Table.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.binary())], names=["block", "places"])


def _next_places(key, blocks: pa.Table, found: pa.Table) -> pa.Table:
    """A block with phrase numbers of one level, and its frequent longer phrases, to the numbers of the next level."""
    rows = []
    prefix, after, ids = _entries(found, 3)
    for packed in blocks["places"]:
        at = _unpacked(packed.as_buffer())[0]
        known = np.unique(np.concatenate([prefix, after]))
        code = _find(known, at)
        pair = _find(known, prefix) * len(known) + _find(known, after)
        by = np.argsort(pair)
        both = np.flatnonzero((code[:-1] >= 0) & (code[1:] >= 0))
        hit = _find(pair[by], code[both] * len(known) + code[both + 1])
        new = np.full(len(at), NONE, np.int64)
        new[both[hit >= 0]] = ids[by][hit[hit >= 0]]
        if (new >= 0).any():
            rows.append((key[0].as_py(), _packed(new)))
    return _place_rows(rows)


def _word_places(key, blocks: pa.Table, words: pa.Table) -> pa.Table:
    """A block with its own word numbers, and the numbers of its frequent words, to the numbers of level 1."""
    rows = []
    own, ids = _entries(words, 2)
    for packed in blocks["places"]:
        at = _unpacked(packed.as_buffer())[0]
        new = np.full(int(max(at.max(), own.max(initial=0))) + 2, NONE, np.int64)
        new[own] = ids
        rows.append((key[0].as_py(), _packed(new[at])))  # place -1 reads the last entry, which is NONE
    return _place_rows(rows)


def frequent_phrases(docs: DataFrame, options: PhraseOptions = PhraseOptions()) -> tuple[DataFrame, DataFrame]:
    """All phrases of 1 to ``words`` words with ``min_count`` occurrences, and the words of each language.

    First: ``lang, m, id, phrase, last, a`` (frequency), ``heads`` and ``tails`` (frequencies of the first and last 1, 2, ... m
    words) and ``longest``, the largest frequency of a phrase one word longer that holds it.  Second: ``lang, n``.
    """
    d = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    blocks = stored(d.mapInArrow(_blocks(options.block_bytes), BLOCKS), "phrases-blocks")
    n = blocks.select(F.explode(F.arrays_zip("langs", "totals")).alias("x")).groupBy(F.col("x.langs").alias("lang")).agg(F.sum("x.totals").alias("n"))
    n_places = n.agg(F.sum("n")).first()[0] or 0
    buckets = min(max(math.ceil(n_places / options.bucket), FEWEST_BUCKETS), MOST_BUCKETS)

    def merge(rows: DataFrame, merged, schema: str, name: str) -> tuple[DataFrame, DataFrame]:
        """What is frequent, row by row, and the answers to blocks; a bucket lies in one task."""
        x = stored(rows.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(merged(options), schema), name)
        zipped = F.arrays_zip(*x.columns[2:])
        return x.filter("block is null").select(F.explode(zipped).alias("x")).select("x.*"), x.filter("block is not null").select(F.col("block").alias("of"), "entries")

    rows = blocks.select("block", "langs", "words", "entries").mapInArrow(_word_stripes(buckets), WORD_STRIPES)
    frequent, mine = merge(rows, _merged_words, MERGED_WORDS, "phrases-words")
    frequent = frequent.select("lang", "word", F.col("count").alias("c"), F.col("ids").alias("id"))
    places = blocks.select("block", "places").groupBy("block").cogroup(mine.groupBy("of")).applyInArrow(_word_places, PLACES)
    word = F.col("word").cast("string")
    level = frequent.select("lang", F.lit(1).alias("m"), "id", word.alias("phrase"), word.alias("last"), F.col("c").alias("a"), F.array("c").alias("heads"), F.array("c").alias("tails"))
    levels, covers = [level], []
    for m in range(2, options.words + 1):
        places = stored(places, f"phrases-places{m - 1}")
        found, shared = merge(places.mapInArrow(_stripes(buckets), STRIPES), _merged, MERGED, f"phrases-merged{m}")
        found = found.select("prefix", F.col("next").alias("suffix"), F.col("count").alias("c"), F.col("ids").alias("id"))
        covers += [found.select(F.col("prefix").alias("id"), "c", F.lit(m - 1).alias("m")), found.select(F.col("suffix").alias("id"), "c", F.lit(m - 1).alias("m"))]
        head = level.select(F.col("id").alias("prefix"), "lang", F.col("phrase").alias("begin"), "heads")
        tail = level.select(F.col("id").alias("suffix"), "last", "tails")
        level = stored(
            found.join(head, "prefix").join(tail, "suffix").select(
                "lang", F.lit(m).alias("m"), "id", F.concat_ws(" ", "begin", "last").alias("phrase"), "last", F.col("c").alias("a"),
                F.concat("heads", F.array("c")).alias("heads"), F.concat("tails", F.array("c")).alias("tails")), f"phrases-level{m}")
        levels.append(level)
        if m < options.words:
            places = places.groupBy("block").cogroup(shared.groupBy("of")).applyInArrow(_next_places, PLACES)
    longest = covers[0]
    for c in covers[1:]:
        longest = longest.unionByName(c)
    longest = longest.groupBy("m", "id").agg(F.max("c").alias("longest"))
    phrases = levels[0]
    for x in levels[1:]:
        phrases = phrases.unionByName(x)
    return phrases.join(longest, ["m", "id"], "left"), n


def collocations(docs: DataFrame, options: PhraseOptions = PhraseOptions()) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the first ``top`` phrases of two words and more of each language.

    ``docs(lang, text)``: a null language is ``und``, a null text empty.  ``score`` is the least of
    ``floor(1000 * a * n / (l * r))`` over all cuts of a phrase in two, ties to the first cut; ``l`` and ``r`` are
    the frequencies of the parts.  A phrase inside a longer one of the same frequency is left out.  Ranks follow
    score, frequency and phrase (byte order).  Repeated rows count; a language without frequent phrases has
    no rows, nor has an empty table; further columns are ignored.
    """
    phrases, n = frequent_phrases(docs, options)
    open_ones = phrases.filter((F.col("m") > 1) & (F.coalesce("longest", F.lit(0)) < F.col("a"))).join(n, "lang")
    exact = "decimal(38,0)"

    def cut(k):
        left, right = F.element_at("heads", k), F.element_at("tails", F.col("m") - k)
        return F.struct(F.lit(0).cast("long").alias("score"), k.alias("k"), left.alias("l"), right.alias("r"))

    cuts = F.transform(F.sequence(F.lit(1), F.col("m") - 1), cut)
    rows = open_ones.select("lang", "phrase", "a", "n", F.explode(cuts).alias("x"))
    score = F.expr(f"(cast(1000 * cast(a as decimal(19,0)) as {exact}) * cast(n as decimal(15,0))) div (cast(x.l as decimal(19,0)) * cast(x.r as decimal(19,0)))")
    rows = rows.select("lang", "phrase", "a", "n", F.struct(score.cast("long").alias("score"), F.col("x.k").alias("k"), F.col("x.l").alias("l"), F.col("x.r").alias("r")).alias("x"))
    best = rows.groupBy("lang", "phrase", "a", "n").agg(F.min("x").alias("x")).select("lang", "phrase", "a", "x.l", "x.r", "n", "x.score")
    ranked = top_per_key(best, ["lang"], [F.col("score").desc(), F.col("a").desc(), F.col("phrase")], options.top)
    return ranked.select("lang", F.col("rn").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


SQL = r"""
WITH d AS (
  SELECT coalesce(lang, 'und') AS lang,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
p AS (SELECT lang, unnest(regexp_split_to_array(text, '[.,;:!?\x0A-\x0D]')) AS piece FROM d),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS words FROM p),
t AS (SELECT lang, sum(len(words))::BIGINT AS n FROM w GROUP BY lang),
g AS (SELECT lang, m, array_to_string(words[i:i + m - 1], ' ') AS phrase
      FROM w, range(1, 6) x(m), unnest(range(1, len(words) - m + 2)) y(i)),
f AS (SELECT lang, m, phrase, count(*) AS a FROM g GROUP BY ALL HAVING count(*) >= 100),
c AS (SELECT lang, m, phrase, a, string_split(phrase, ' ') AS words FROM f WHERE m > 1),
covered AS (
  SELECT DISTINCT s.lang, s.phrase FROM c s JOIN c b ON b.lang = s.lang AND b.m > s.m AND 100 * b.a >= 100 * s.a
  AND contains(' ' || b.phrase || ' ', ' ' || s.phrase || ' ')),
k AS (SELECT c.*, unnest(range(1, c.m)) AS k FROM c ANTI JOIN covered USING (lang, phrase)),
s AS (
  SELECT k.lang, k.phrase, k.a, k.k, x.a AS l, y.a AS r, t.n, ((1000::HUGEINT * k.a * t.n) // (x.a::HUGEINT * y.a))::BIGINT AS score
  FROM k JOIN t ON t.lang = k.lang
  JOIN f x ON x.lang = k.lang AND x.m = k.k AND x.phrase = array_to_string(k.words[1:k.k], ' ')
  JOIN f y ON y.lang = k.lang AND y.m = k.m - k.k AND y.phrase = array_to_string(k.words[k.k + 1:], ' ')),
b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM b QUALIFY rank <= 2000
"""


@query("op12_phrase_collocations", SQL)
def op12_phrase_collocations(spark, sf):
    return collocations(read(spark, sf, "documents"))
