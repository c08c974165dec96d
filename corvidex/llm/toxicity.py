"""Toxicity by a weighted finite-state pattern grammar.

A text is cut into clauses and its words are annotated with classes: insult,
threat, target, negation and reported speech.  Five transducers read a clause's
classes in step, composed into one machine; what they emit tells insults that
are meant from negated or reported ones, insults at a target, and threats to
one.  Clauses are scored, not words: the emissions of a text's clauses are
weighed by a logistic model.

The insult lexicon (words and word beginnings, so that inflected and compound
forms of any language count) is learned from labelled training rows, as are the
weights.  Only the text is ever an input of a score.
"""

from __future__ import annotations

import math
import zlib
from collections import defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

#: Labelled rows that are learned from, at most; the bound keeps the broadcast and the driver's matrix small.
SAMPLE = 20_000
#: Lengths of word beginnings that may be entries, in code points.
STEMS = (4, 5, 6)

#: Closed classes. They only steer the machine; insults are learned.
THREATS = "kill hurt destroy beat burn shoot stab smash attack töten schlagen vernichten tuer frapper détruire matar golpear destruir".split()
TARGETS = "you your he she they them him her those people du dich ihr euch sie tu toi vous eux elle ils tú te usted ellos".split()
NEGATIONS = "not no never nobody isn't aren't wasn't don't nicht kein keine nie pas jamais aucun nunca jamás ningún".split()
REPORTS = "said says wrote writes claimed claims called quoted sagte schrieb behauptete dit écrit affirmé dijo escribió afirmó".split()

INSULT, THREAT, TARGET, NEGATION, REPORT, WORD = range(6)
CLASSES = {**dict.fromkeys(THREATS, THREAT), **dict.fromkeys(TARGETS, TARGET), **dict.fromkeys(NEGATIONS, NEGATION), **dict.fromkeys(REPORTS, REPORT)}


# --- transducers ------------------------------------------------------------


@dataclass(frozen=True)
class Transducer:
    """Deterministic: ``arcs[state, class] = (state, emission or None)``; a missing arc stays and emits nothing."""

    name: str
    arcs: dict[tuple[int, int], tuple[int, str | None]]
    states: int

    def read(self, state: int, kind: int) -> tuple[int, str | None]:
        return self.arcs.get((state, kind), (state, None))


def _near(name: str, opens: int, closes: int, reach: int, emits: str) -> Transducer:
    """Emits if ``closes`` comes within ``reach`` words of ``opens``."""
    arcs: dict[tuple[int, int], tuple[int, str | None]] = {}
    for state in range(reach + 1):
        for kind in range(6):
            arcs[state, kind] = ((state + 1 if 0 < state < reach else 0), None)
        if state:
            arcs[state, closes] = ((state + 1 if state < reach else 0), emits)
        arcs[state, opens] = (1, emits if state and opens == closes else None)
    return Transducer(name, arcs, reach + 1)


INSULTS = Transducer("insult", {(0, INSULT): (0, "insult")}, 1)
NEGATED = _near("negation", NEGATION, INSULT, 3, "negated")
REPORTED = Transducer("reported", {(0, REPORT): (1, None), (1, INSULT): (1, "reported")}, 2)
#: 1: a target was read, 2: an insult was read.
AIMED = Transducer("target", {(0, TARGET): (1, None), (0, INSULT): (2, None), (1, INSULT): (1, "aimed"), (2, TARGET): (1, "aimed")}, 3)
THREATENED = _near("threat", THREAT, TARGET, 4, "threat")


@dataclass
class Composed:
    """The product of transducers over one tape; states are numbered as they are reached."""

    parts: tuple[Transducer, ...]
    numbers: dict[tuple[int, ...], int] = field(default_factory=dict)
    arcs: list[list[tuple[int, tuple[str, ...]]]] = field(default_factory=list)

    def __post_init__(self) -> None:
        queue = [tuple(0 for _ in self.parts)]
        self.numbers[queue[0]] = 0
        for states in queue:
            row = []
            for kind in range(6):
                went = [p.read(s, kind) for p, s in zip(self.parts, states, strict=True)]
                to = tuple(s for s, _ in went)
                if to not in self.numbers:
                    self.numbers[to] = len(self.numbers)
                    queue.append(to)
                row.append((self.numbers[to], tuple(e for _, e in went if e)))
            self.arcs.append(row)


GRAMMAR = Composed((INSULTS, NEGATED, REPORTED, AIMED, THREATENED))

FEATURES = ("meant", "negated", "reported", "aimed", "threats", "clauses", "strongest", "any")


# --- texts --------------------------------------------------------------------

_ENDS = str.maketrans(dict.fromkeys(".!?;:\n", " . ") | dict.fromkeys(",()[]{}<>\"*#$%&|/\\=+_\t\r", " "))


def clauses_text(text: str) -> str:
    """Lower-case words with blanks around them and ``.`` between clauses."""
    return f" {text.lower().translate(_ENDS)} "


def terms_of(text: str) -> set[str]:
    """The words of a text, and their beginnings with ``*``."""
    out: set[str] = set()
    for w in set(clauses_text(text).split()):
        if len(w) >= 3 and any(c.isalpha() for c in w):
            out.add(w)
            out.update(f"{w[:n]}*" for n in STEMS if len(w) > n)
    return out


class Reader:
    """Finds the lexicon's entries and runs the grammar over the clauses that hold one."""

    def __init__(self, lexicon: dict[str, float], grammar: Composed = GRAMMAR):
        self.grammar = grammar
        self.automaton = ahocorasick.Automaton()
        for entry, weight in lexicon.items():
            # A word has a blank on both sides, a beginning on the left only.
            self.automaton.add_word(f" {entry[:-1]}" if entry.endswith("*") else f" {entry} ", (len(entry), weight, not entry.endswith("*")))
        for w in THREATS:
            self.automaton.add_word(f" {w} ", (len(w), 0.0, True)) if f" {w} " not in self.automaton else None
        self.automaton.make_automaton()

    def emissions(self, text: str) -> list[dict[str, float]]:
        """What each clause that holds an insult or a threat verb emits."""
        line = clauses_text(text)
        weight_at: dict[int, float] = {}
        for end, (length, weight, whole) in self.automaton.iter(line):
            start = end - length if whole else end - length + 2
            weight_at[start] = max(weight_at.get(start, 0.0), weight)
        if not weight_at:
            return []
        out, done = [], -1
        for at in sorted(weight_at):
            if at < done:
                continue
            a, z = line.rfind(" . ", 0, at) + 1, line.find(" . ", at)
            z = len(line) if z < 0 else z
            done = z
            out.append(self.run(line, a, z, weight_at))
        return [e for e in out if e]

    def run(self, line: str, a: int, z: int, weight_at: dict[int, float]) -> dict[str, float]:
        state, out, place = 0, defaultdict(float), a
        for word in line[a:z].split(" "):
            if word and word != ".":
                weight = weight_at.get(place, 0.0)
                kind = INSULT if weight > 0 else CLASSES.get(word, WORD)
                state, emitted = self.grammar.arcs[state][kind]
                for e in emitted:
                    out[e] += weight if kind == INSULT else 1.0
            place += len(word) + 1
        return dict(out)

    def features(self, text: str) -> list[float]:
        found = self.emissions(text)
        total = lambda e: sum(c.get(e, 0.0) for c in found)
        meant = [max(0.0, c.get("insult", 0.0) - c.get("negated", 0.0) - c.get("reported", 0.0)) for c in found]
        return [math.log1p(sum(meant)), math.log1p(total("negated")), math.log1p(total("reported")), math.log1p(total("aimed")), math.log1p(total("threat")), math.log1p(sum(m > 0 for m in meant)), max(meant, default=0.0) / 5, float(any(m > 0 for m in meant))]


# --- learning -------------------------------------------------------------------


@dataclass(frozen=True)
class Model:
    lexicon: dict[str, float]
    weights: tuple[float, ...]
    bias: float


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, rounds: int = 50) -> tuple[np.ndarray, float]:
    """Ridge logistic regression by Newton steps; the bias is free."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x.shape[1])
    keep = np.full(x.shape[1], ridge)
    keep[-1] = 1e-3
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (p - y) + keep * w
        hessian = (x * (p * (1 - p))[:, None]).T @ x + np.diag(keep)
        step = np.linalg.solve(hessian, gradient)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w[:-1], float(w[-1])


#: What speaks for the label: rows, how many times the others, and log odds less twice their error.
LEAST_ROWS, TIMES, LEAST_ODDS = 3, 4, 1.5


def weigh(counts: Iterable[tuple[str, int, int]], positive: int, negative: int) -> dict[str, float]:
    """Entries whose presence speaks for the label, with their log odds: no entry that another one covers.

    Evidence decides, not a number of entries. Entries that speak equally are
    all kept; their order doesn't matter.
    """
    odds_of, rows = {}, {}
    for term, n1, n0 in counts:
        odds = math.log((n1 + 0.5) / (positive + 1)) - math.log((n0 + 0.5) / (negative + 1))
        # Chance alone gives rare terms high odds: ask for several rows and for high precision.
        if n1 >= LEAST_ROWS and n1 >= TIMES * n0 and odds - 2 / math.sqrt(n1) > LEAST_ODDS:
            odds_of[term], rows[term] = odds, n1
    # A beginning that stands in hardly more rows than one longer entry says nothing that this doesn't say more precisely.
    largest: dict[str, int] = defaultdict(int)
    for term, n1 in rows.items():
        for k in STEMS:
            if k < len(term.rstrip("*")):
                largest[f"{term[:k]}*"] = max(largest[f"{term[:k]}*"], n1)
    kept = {t for t, n1 in rows.items() if largest[t] < 0.9 * n1}
    return {term: odds for term, odds in sorted(odds_of.items()) if term in kept and not any(f"{term[:k]}*" in kept for k in STEMS if k < len(term.rstrip("*")))}


def learn(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Learn from at most ``sample`` labelled rows, taken by a hash of their number, none of them held out.

    ``labels`` with a null number or label don't count; of several labels for a
    document the greatest does. Labels of one class alone tell nothing apart:
    without one that is clean every text scores 1/3, without a toxic one less.
    """
    common.arrow_batches(docs.sparkSession)
    chosen = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").where(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5)) != 0)
    chosen = chosen.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(F.col("toxic").cast("int")).alias("toxic")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    rows = common.materialize(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).join(F.broadcast(common.materialize(chosen, "toxic-labels")), "doc_id").select("text", "toxic"), "toxic-sample")

    def terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: dict[str, list[int]] = defaultdict(lambda: [0, 0])
            for text, y in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                for t in terms_of(text):
                    counts[t][y > 0] += 1
            yield pa.RecordBatch.from_pydict({"term": pa.array(counts.keys(), pa.string()), "n1": pa.array([c[1] for c in counts.values()], pa.int64()), "n0": pa.array([c[0] for c in counts.values()], pa.int64())})

    n, positive = rows.agg(F.count("*"), F.coalesce(F.sum((F.col("toxic") > 0).cast("int")), F.lit(0))).first()
    grouped = rows.mapInArrow(terms, "term string, n1 long, n0 long").groupBy("term").agg(F.sum("n1").alias("n1"), F.sum("n0").alias("n0"))
    # The same test as ``weigh``'s, where the counts are: what comes back are words of at most ``sample`` rows that speak for the label.
    odds = F.log((F.col("n1") + 0.5) / (positive + 1)) - F.log((F.col("n0") + 0.5) / (n - positive + 1))
    speak = grouped.where((F.col("n1") >= LEAST_ROWS) & (F.col("n1") >= TIMES * F.col("n0")) & (odds - 2 / F.sqrt("n1") > LEAST_ODDS - 1e-9))
    lexicon = weigh(((r.term, r.n1, r.n0) for r in speak.toLocalIterator()), positive, n - positive)
    reader_of = docs.sparkSession.sparkContext.broadcast(lexicon)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(reader_of.value)
        for batch in batches:
            texts, ys = (c.to_pylist() for c in batch.columns)
            yield pa.RecordBatch.from_pydict({"x": pa.array([reader.features(t) for t in texts], pa.list_(pa.float64())), "y": pa.array([int(y > 0) for y in ys], pa.int32())})

    seen = rows.mapInArrow(measure, "x array<double>, y int").collect()  # at most ``sample`` rows of eight numbers
    if not positive or positive == n:
        return Model(lexicon, (0.0,) * len(FEATURES), math.log(0.5 / (n - positive + 1)))
    w, b = fit_logistic(np.array([r.x for r in seen]), np.array([r.y for r in seen], float))
    return Model(lexicon, tuple(w.tolist()), b)


def held_out(doc_id: int | None) -> bool:
    """A null number is not held out."""
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 == 0


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, held_out, score, predicted, n_clauses`` for every row of ``docs``, in one pass without a shuffle.

    Null texts are empty and score by the bias alone. Texts are read whole, in
    time proportional to their length. Repeated rows come back as often, a null
    number too; equal texts have equal scores. Other columns aren't read.
    """
    common.arrow_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        reader, w = Reader(m.lexicon), np.array(m.weights)
        for batch in batches:
            ids, texts = (c.to_pylist() for c in batch.columns)
            x = np.array([reader.features(t or "") for t in texts]).reshape(len(texts), len(FEATURES))
            p = 1 / (1 + np.exp(-np.clip(x @ w + m.bias, -30, 30)))
            yield pa.RecordBatch.from_pydict({"doc_id": pa.array(ids, pa.int64()), "held_out": pa.array([held_out(i) for i in ids]), "score": pa.array(p), "predicted": pa.array((p >= 0.5).astype(np.int32)), "n_clauses": pa.array(np.rint(np.expm1(x[:, 5])).astype(np.int64))})

    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return slim.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int, n_clauses long")
