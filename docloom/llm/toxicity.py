"""Toxicity by a weighted finite-state grammar over clauses.

A word is tagged by prefix patterns (insult, threat, target, negation, report).  Three transducers
read the tags of a clause and rewrite them: negation marks what stands in its scope, reported speech
marks what follows it, and the target transducer marks insults and threats near a person spoken to.
They are composed into one machine, built once.  A clause is worth the sum of the pattern weights
by the symbols the machine writes; an isolated word never scores by itself, only as part of its clause.

Insult patterns and all weights are learned from labelled rows: prefixes and whole words whose document
counts differ between toxic and other texts by a likelihood-ratio test, near copies counted once; then
a logistic fit of the clause sums.  The fit uses at most ``sample`` labelled rows, chosen by a hash of
the id; that is the documented bound of the classifier.  Scoring reads every text whole.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.llm.common import crc_mod, read, stored
from docloom.llm.registry import query

OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT = range(6)
NEG_INSULT, NEG_THREAT, REP_INSULT, REP_THREAT, DIR_INSULT, DIR_THREAT, LATE_TARGET = range(6, 13)
SYMBOLS = 13
#: What a clause is summed by: these output symbols, one feature each.
SCORED = (INSULT, THREAT, NEG_INSULT, NEG_THREAT, REP_INSULT, REP_THREAT, DIR_INSULT, DIR_THREAT, LATE_TARGET)

# Seed patterns in four languages; a star marks a prefix.  Insults are added by learning.
SEEDS = {
    INSULT: "idiot* moron* stupid* imbecile* dumm* trottel* crétin* estúpid* imbécil*",
    THREAT: "kill* murder* hurt* töte* umbring* verletz* tuer* tuera* mata* mataré* destroy* zerstör*",
    TARGET: "you your yours yourself u du dich dir dein* euch ihr vous tu toi ton votre vos tú te ti usted ustedes vosotros they them",
    NEGATION: "not no never isn't aren't don't nicht kein* nie niemals ne pas jamais aucun* nunca jamás ni",
    REPORT: "said says say wrote quoted claimed reported sagt* sagte* schrieb* zitiert* dit disait écrit cité dijo dice escribió citó",
}
CLAUSE_END = re.compile(r"[.!?;:\n]+|,(?=\s)")
WORD = re.compile(r"[^\W_]+(?:'[^\W_]+)?")


@dataclass(frozen=True)
class ToxicityOptions:
    """``sample``: labelled rows the fit may use at most; ``shortest``, ``longest``: learned prefixes;
    ``support``, ``support_share``: toxic texts a pattern needs, as a number and as a share; ``scope``: words a negation reaches; ``reach``: words to a target."""

    sample: int = 20_000
    shortest: int = 4
    longest: int = 10
    support: int = 4
    support_share: float = 0.01
    scope: int = 3
    reach: int = 4


@dataclass
class Transducer:
    """``step[state][symbol] = (next state, symbol written)``; state 0 starts each clause."""

    step: list[list[tuple[int, int]]]

    def compose(self, then: Transducer) -> Transducer:
        """The machine that feeds what this one writes into ``then``."""
        width = len(then.step)
        out = []
        for a in self.step:
            for b in then.step:
                row = []
                for s in range(SYMBOLS):
                    na, written = a[s]
                    nb, final = b[written]
                    row.append((na * width + nb, final))
                out.append(row)
        return Transducer(out)


def negation(scope: int) -> Transducer:
    inside = {INSULT: NEG_INSULT, THREAT: NEG_THREAT}
    return Transducer([[(scope if s == NEGATION else max(0, n - 1), inside.get(s, s) if n else s) for s in range(SYMBOLS)] for n in range(scope + 1)])


def reported() -> Transducer:
    inside = {INSULT: REP_INSULT, THREAT: REP_THREAT}
    return Transducer([[(1 if n or s == REPORT else 0, inside.get(s, s) if n else s) for s in range(SYMBOLS)] for n in range(2)])


def target(reach: int) -> Transducer:
    """States: 0 nothing near; 1..reach a target that many words ahead still counts; beyond: an insult waits for one."""
    near = {INSULT: DIR_INSULT, THREAT: DIR_THREAT}
    rows = []
    for n in range(2 * reach + 1):
        row = []
        for s in range(SYMBOLS):
            if s == TARGET:
                row.append((reach, LATE_TARGET if n > reach else TARGET))
            elif s in near:
                row.append((n, near[s]) if 0 < n <= reach else (2 * reach, s))
            else:
                row.append((n - 1 if 0 < n <= reach or n > reach + 1 else 0, s))
        rows.append(row)
    return Transducer(rows)


@dataclass
class Grammar:
    """Weighted patterns, the composed machine and the fitted logistic weights."""

    options: ToxicityOptions
    exact: dict[str, tuple[int, float]] = field(default_factory=dict)
    prefix: dict[str, tuple[int, float]] = field(default_factory=dict)
    weights: np.ndarray | None = None

    def __post_init__(self):
        o = self.options
        self.machine = negation(o.scope).compose(reported()).compose(target(o.reach)).step
        for tag, text in SEEDS.items():
            for p in text.split():
                self.add(p, tag, 1.0)

    def add(self, pattern: str, tag: int, weight: float) -> None:
        (self.prefix if pattern.endswith("*") else self.exact)[pattern.rstrip("*")] = (tag, weight)

    def close(self) -> Grammar:
        import ahocorasick

        self.lengths = sorted({len(p) for p in self.prefix}, reverse=True)
        self.finder = ahocorasick.Automaton()
        for p, (tag, _) in [*self.exact.items(), *self.prefix.items()]:
            if tag in (INSULT, THREAT):
                self.finder.add_word(p, 1)
        self.finder.make_automaton()
        return self

    def __getstate__(self):  # the finder is built again where the grammar arrives
        return {k: v for k, v in self.__dict__.items() if k != "finder"}

    def __setstate__(self, state):
        self.__dict__.update(state)
        self.close()

    def tag(self, word: str) -> tuple[int, float]:
        hit = self.exact.get(word)
        if hit:
            return hit
        for n in self.lengths:
            if n <= len(word):
                hit = self.prefix.get(word[:n])
                if hit:
                    return hit
        return (OTHER, 0.0)

    def clauses(self, text: str) -> Iterator[np.ndarray]:
        """Sums of pattern weights by output symbol, for each clause where the machine writes a scored one."""
        for clause in CLAUSE_END.split(text):
            if next(self.finder.iter(clause), None) is None:
                continue
            state, sums = 0, None
            for w in WORD.findall(clause):
                symbol, weight = self.tag(w)
                state, written = self.machine[state][symbol]
                if written in SCORED:
                    if sums is None:
                        sums = np.zeros(SYMBOLS)
                    sums[written] += weight or 1.0
            if sums is not None:
                yield sums

    def features(self, text: str | None) -> np.ndarray:
        """Per scored symbol: log of one plus the sum over clauses; then the number of scored clauses, logged."""
        out = np.zeros(len(SCORED) + 1)
        if not text:
            return out
        text = text.lower()
        if next(self.finder.iter(text), None) is None:
            return out
        n, total = 0, np.zeros(SYMBOLS)
        for sums in self.clauses(text):
            n += 1
            total += sums
        out[:-1] = np.log1p(total[list(SCORED)])
        out[-1] = np.log1p(n)
        return out

    def score(self, x: np.ndarray) -> np.ndarray:
        w = self.weights
        return 1 / (1 + np.exp(-np.clip(x @ w[1:] + w[0], -35, 35)))


#: Used where no labels exist: bias, then one weight for each scored symbol and the clause count.
PRIOR = np.array([-3.0, 2.0, 2.5, -0.5, -0.5, 0.5, 0.5, 3.0, 4.0, 1.0, 0.5])


def patterns(text: str | None, o: ToxicityOptions) -> set[str]:
    out = set()
    for w in set(WORD.findall((text or "").lower())):
        out.add(w)
        out.update(w[:n] + "*" for n in range(o.shortest, min(len(w), o.longest) + 1))
    return out


def copy_mark(text: str | None) -> int:
    """Least hash of the five-word shingles: near copies mostly share it."""
    w = (text or "").lower().split()
    return min((xxhash.xxh3_64_intdigest(" ".join(w[i : i + 5])) >> 1 for i in range(max(1, len(w) - 4))), default=0)


def _marks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        marks = pa.array([copy_mark(t.as_py()) for t in b.column(0)], pa.int64())
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), marks], names=["text", "toxic", "mark"])


def _pattern_counts(o: ToxicityOptions, wanted=None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter = Counter()
        for b in batches:
            for t in b.column(0):
                p = patterns(t.as_py(), o)
                found.update(p if wanted is None else p & wanted.value)
            if len(found) > 500_000:
                yield pa.RecordBatch.from_pydict({"p": list(found), "n": list(found.values())})
                found = Counter()
        if found:
            yield pa.RecordBatch.from_pydict({"p": list(found), "n": list(found.values())})

    return run


def _features(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        g = shared.value
        for b in batches:
            x = [g.features(t.as_py()).tolist() for t in b.column(0)]
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.list_(pa.float64())), b.column(1)], names=["x", "toxic"])

    return run


def choose_patterns(toxic: dict[str, int], clean: dict[str, int], n_toxic: int, n_clean: int) -> list[tuple[str, float]]:
    """Patterns that pass the likelihood-ratio test, most telling first; of nested ones the first stays."""
    def part(k, n, p):
        return k * np.log(p) if k else 0.0 + 0.0 * n

    scored = []
    for p, k in toxic.items():
        c = clean.get(p, 0)
        if k / n_toxic <= 4 * c / max(1, n_clean):
            continue
        share = (k + c) / (n_toxic + n_clean)
        g2 = 2 * (part(k, n_toxic, k / n_toxic / share) + part(c, n_clean, c / max(1, n_clean) / share)
                  + part(n_toxic - k, n_toxic, (1 - k / n_toxic) / (1 - share)) + part(n_clean - c, n_clean, (1 - c / max(1, n_clean)) / (1 - share)))
        scored.append((g2, p.rstrip("*"), p, np.log((k + 0.5) / (n_toxic + 1) * (n_clean + 1) / (c + 0.5))))
    floor = 2 * np.log(max(2, len(toxic))) + 4
    chosen: list[tuple[str, float]] = []
    taken: set[str] = set()
    above: set[str] = set()  # all prefixes of what is taken
    for g2, bare, p, w in sorted(scored, key=lambda s: (-round(s[0], 6), -len(s[1]), s[2])):
        if g2 < floor:
            break
        if bare in above or any(bare[:n] in taken for n in range(1, len(bare) + 1)):
            continue
        chosen.append((p, float(w)))
        taken.add(bare)
        above.update(bare[:n] for n in range(1, len(bare)))
    return chosen


def logistic(x: np.ndarray, y: np.ndarray, steps: int = 30, ridge: float = 1.0) -> np.ndarray:
    """Ridge logistic regression by Newton's method."""
    a = np.column_stack([np.ones(len(x)), x])
    w = np.zeros(a.shape[1])
    pull = np.full(a.shape[1], ridge)
    pull[0] = 1e-3
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -35, 35)))
        step = np.linalg.solve((a * (p * (1 - p))[:, None]).T @ a + np.diag(pull), a.T @ (p - y) + pull * w)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def learn(sample: DataFrame, options: ToxicityOptions = ToxicityOptions()) -> Grammar:
    """Fit a grammar to ``sample(text, toxic)``; no or one-sided labels give the prior weights."""
    o, spark = options, sample.sparkSession
    rows = sample.select("text", F.col("toxic").cast("int")).mapInArrow(_marks, "text string, toxic int, mark long")
    rows = stored(rows.dropDuplicates(["mark", "toxic"]).select("text", "toxic"), "toxic-sample")
    sizes = dict(rows.groupBy("toxic").count().collect())
    n_toxic, n_clean = sizes.get(1, 0), sizes.get(0, 0)
    g = Grammar(o)
    if not n_toxic or not n_clean:
        g.weights = PRIOR
        return g.close()
    counts = rows.filter("toxic = 1").select("text").mapInArrow(_pattern_counts(o), "p string, n long")
    need = max(o.support, int(n_toxic * o.support_share))
    toxic = dict(counts.groupBy("p").agg(F.sum("n").alias("n")).filter(F.col("n") >= need).collect())
    wanted = spark.sparkContext.broadcast(frozenset(toxic))
    clean = rows.filter("toxic = 0").select("text").mapInArrow(_pattern_counts(o, wanted), "p string, n long")
    clean = dict(clean.groupBy("p").agg(F.sum("n").alias("n")).collect())
    for p, w in choose_patterns(toxic, clean, n_toxic, n_clean):
        if p.rstrip("*") not in g.exact:
            g.add(p, INSULT, w)
    g.close()
    pdf = rows.select("text", "toxic").mapInArrow(_features(spark.sparkContext.broadcast(g)), "x array<double>, toxic int").toPandas()
    g.weights = logistic(np.array(pdf["x"].tolist()), pdf["toxic"].to_numpy(float))
    return g


def _scores(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        g = shared.value
        for b in batches:
            x = np.array([g.features(t.as_py()) for t in b.column(1)]).reshape(b.num_rows, len(SCORED) + 1)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(g.score(x))], names=["doc_id", "held_out", "score"])

    return run


def _drop(shared, at: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        g = shared.value
        for b in batches:
            x = np.array([g.features(t.as_py()) for t in b.column(at)]).reshape(b.num_rows, len(SCORED) + 1)
            yield b.filter(pa.array(g.score(x) < 0.5))

    return run


def fit(docs: DataFrame, labels: DataFrame, options: ToxicityOptions = ToxicityOptions()) -> Grammar:
    """Learn from the labels of ``docs`` outside the held-out fold (crc32(doc_id) mod 5 is 0)."""
    o = options
    known = labels.filter("doc_id is not null and toxic is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").alias("toxic"))
    d = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).filter(crc_mod(F.col("doc_id"), 5) != 0)
    # the sample is chosen from ids alone; at most o.sample of them are broadcast to the texts
    chosen = known.join(d.select("doc_id"), "doc_id", "left_semi").orderBy(F.xxhash64("doc_id"), "doc_id").limit(o.sample)
    return learn(d.join(F.broadcast(chosen), "doc_id"), o)


def drop_toxic(docs: DataFrame, labels: DataFrame, options: ToxicityOptions = ToxicityOptions()) -> DataFrame:
    """The rows of ``docs`` that score under 0.5, all columns as they are."""
    shared = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, options))
    return docs.mapInArrow(_drop(shared, docs.columns.index("text")), docs.schema)


def score_documents(docs: DataFrame, labels: DataFrame, options: ToxicityOptions = ToxicityOptions()) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for each row of ``docs(doc_id, text)``.

    Learns from ``labels(doc_id, toxic)`` of rows whose crc32(doc_id) mod 5 is not 0.  A null or empty
    text has no clause and gets the score of that; a null id is scored and has no label; of
    contradicting labels of one id the larger counts; null labels count as none.  Further columns are ignored.
    """
    d = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), (crc_mod(F.col("doc_id"), 5) == 0).alias("held_out"))
    shared = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, options))
    out = d.mapInArrow(_scores(shared), "doc_id long, held_out boolean, score double")
    return out.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


@query("op3_toxicity_grammar")
def op3_toxicity_grammar(spark, sf):
    return score_documents(read(spark, sf, "documents"), read(spark, sf, "labels"))
