"""Toxic spans by a linear-chain conditional random field.

Documents carry only a document label, so tokens are labelled first: a word or
word beginning that occurs far more often in toxic than in clean documents is a
cue, and a token of a toxic document that has a cue is labelled toxic.  A
two-state chain over word, affix and shape features is fitted to the labelled
tokens; forward-backward marginals give the toxic spans, and a logistic
function of their document totals, fitted to the document labels, the score.

Tokens are runs of letters and digits of one kind of script; all else (blanks,
punctuation, markup) parts them.  A run longer than a word usually is, or of a
script written without blanks, is cut into pieces that are each tagged: at known
cue words inside it, and else after a fixed number of characters.  So every
letter of a text is read as part of some token.

Defined results: a null or empty text, or one without letters and digits, has no span and the score of an
uneventful text; without a toxic and a clean labelled document there is no
model, every score is 0 and no span is found.  Repeated rows are scored alike,
extra columns are passed through, and columns named like a result are replaced.

Scale: fitting reads at most ``max_labelled`` labelled documents (those with the
smallest hash of their id, so the same ones on any cluster); scoring is one
pass without a shuffle, in batches, over whole texts.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardwatch.llm import common

#: Scripts written without blanks between words: Thai to Khmer, Chinese, Japanese, Korean.
DENSE = "\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u2e80-\u9fff\uac00-\ud7af\uf900-\ufaff\U00020000-\U0003ffff"
RUN = re.compile(f"[0-9A-Za-z\u00c0-\u024f]+|[{DENSE}]+|[^\\W_0-9A-Za-z\u00c0-\u024f{DENSE}]+")
#: A text's bytes with blanks for all ASCII but letters and digits: what is left between blanks holds whole runs.
BLANKED = bytes(c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))
#: Characters of a piece: of a run longer than this, and of a run of a dense script.
PIECE, DENSE_PIECE = 14, 4
#: Letters that a cue word has at least to be looked for inside a run.
INSIDE = 4
PREFIXES = (3, 4, 5, 6, 7)
#: Steps of the grid that a text's chain is laid out in; messages go on from one column to the next.
CHAIN = 64
#: A message that changes by less than this is not carried further; each step makes a change smaller.
SAME = 1e-12
#: Distinct stretches of runs whose scores a worker remembers, and the longest of them in bytes.
REMEMBERED, LONGEST = 300_000, 64
THRESHOLD = 0.7
SPAN_MARGINAL = 0.5

FIELDS = [
    T.StructField("toxic_score", T.DoubleType()),
    T.StructField("toxic_spans", T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()),
                                                           T.StructField("end", T.IntegerType())]))),
    T.StructField("is_toxic", T.BooleanType()),
]


class Cutter:
    """Cuts runs into tokens; ``inside`` are the words looked for within long runs."""

    def __init__(self, inside: Iterable[str] = ()):
        self.automaton = ahocorasick.Automaton()
        for word in inside:
            self.automaton.add_word(word, word)
        if len(self.automaton):
            self.automaton.make_automaton()
        self.is_dense = re.compile(f"[{DENSE}]").match

    def sizes(self, run: str) -> list[int]:
        """Lengths of the run's tokens, in order."""
        most = DENSE_PIECE if self.is_dense(run) else PIECE
        if len(run) <= most:
            return [len(run)]
        out, at = [], 0

        def even(stop: int) -> None:
            nonlocal at
            while at < stop:
                out.append(min(most, stop - at))
                at += out[-1]

        if len(self.automaton):
            lowered = "".join(c.lower() if len(c.lower()) == 1 else c for c in run)  # as long as the run
            for end, word in self.automaton.iter_long(lowered):  # leftmost longest, without overlaps
                even(end + 1 - len(word))
                out.append(len(word))
                at = end + 1
        even(len(run))
        return out

    def cut(self, stretch: str) -> list[str]:
        """Tokens of a stretch of a text."""
        if len(stretch) <= PIECE and stretch.isascii() and stretch.isalnum():
            return [stretch]
        out = []
        for run in RUN.findall(stretch):
            at = 0
            for size in self.sizes(run):
                out.append(run[at:at + size])
                at += size
        return out

    def tokens(self, text: str | None) -> list[str]:
        """All tokens of a text."""
        return [t for stretch in stretches(text or "") for t in self.cut(stretch.decode())]


def stretches(text: str) -> list[bytes]:
    """The text between ASCII characters that are no letters or digits, as UTF-8; runs lie within these."""
    return text.encode("utf-8", "replace").translate(BLANKED).split()


def features(token: str) -> list[str]:
    """Word, beginnings, ending and shape of one token."""
    w = token.lower()
    out = ["w=" + w]
    out += [f"p{n}={w[:n]}" for n in PREFIXES if len(w) > n]
    out.append("s3=" + w[-3:])
    if any(c.isdigit() for c in w):
        out.append("digit")
    return out


def cues(token: str) -> list[str]:
    """What may be a cue: the word and its longer beginnings."""
    w = token.lower()
    return ["w=" + w] + [f"p{n}={w[:n]}" for n in PREFIXES if n >= 4 and len(w) > n] if len(w) >= 3 else []


@dataclass
class Model:
    """Feature weights of the toxic state, the chain's weights, the document calibration and the words looked for inside runs."""

    weights: dict[str, float] = field(default_factory=dict)
    bias: float = -6.0
    move: tuple[float, float, float, float] = (0.0, 0.0, 0.0, 0.0)
    doc: tuple[float, ...] = ()
    inside: tuple[str, ...] = ()


def chains(scores: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Token scores of documents laid out in columns: a matrix (step, column), and step and column of each token."""
    total = int(lengths.sum())
    starts = np.repeat(np.cumsum(lengths) - lengths, lengths)
    place = np.arange(total) - starts
    per_doc = -(-lengths // CHAIN)
    first = np.cumsum(per_doc) - per_doc
    chain = np.repeat(first, lengths) + place // CHAIN
    step = place % CHAIN
    grid = np.zeros((CHAIN, int(per_doc.sum())))
    grid[step, chain] = scores
    return grid, step, chain


def marginals(grid: np.ndarray, move: Iterable[float], size: np.ndarray | None = None,
              follows: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Odds of the toxic state at each step of each chain.

    ``grid`` holds the toxic state's score over the clean state's.  Two states
    need only their ratio: forward and backward messages are log odds.  ``size``
    is the number of real steps of each column (all by default); padding after
    them changes nothing.  ``follows`` marks columns that continue the column
    before them, which is full: both messages are carried over that border, so
    the marginals are those of the whole chain.
    Returns the marginal, and the forward and backward log odds.
    """
    cc, ct, tc, tt = move
    steps, n = grid.shape
    size = np.full(n, steps) if size is None else size
    ahead = lambda a: np.logaddexp(ct, a + tt) - np.logaddexp(cc, a + tc)
    back = lambda b: np.logaddexp(tc, b + tt) - np.logaddexp(cc, b + ct)
    fwd, bwd = np.empty_like(grid), np.zeros_like(grid)
    fwd[0] = grid[0]
    for k in range(1, steps):
        fwd[k] = grid[k] + ahead(fwd[k - 1])
    for k in range(steps - 2, -1, -1):
        bwd[k] = np.where(k + 1 < size, back(bwd[k + 1] + grid[k + 1]), 0.0)
    later = np.zeros(0, dtype=np.int64) if follows is None else np.flatnonzero(follows)
    go = later
    while len(go):
        message = ahead(fwd[-1, go - 1])
        for k in range(steps):
            new = grid[k, go] + message
            moved = np.abs(new - fwd[k, go]) > SAME
            fwd[k, go] = new
            go, message = go[moved], ahead(new[moved])
        go = np.intersect1d(go + 1, later, assume_unique=True)
    go = later - 1
    while len(go):
        new = back(bwd[0, go + 1] + grid[0, go + 1])
        for k in range(steps - 1, -1, -1):
            moved = np.abs(new - bwd[k, go]) > SAME
            bwd[k, go] = new
            go, new = go[moved], back(new[moved] + grid[k, go[moved]])
        go = np.intersect1d(go, later, assume_unique=True) - 1
    return 1.0 / (1.0 + np.exp(-np.clip(fwd + bwd, -60, 60))), fwd, bwd


def fit_chain(sequences: list[tuple[list[list[str]], list[int]]], rounds: int = 40, l2: float = 0.02) -> Model:
    """Weights that make the labelled tokens likely, by gradient steps with momentum on the exact chain likelihood."""
    count: dict[str, int] = {}
    for seq, _ in sequences:
        for token in seq:
            for f in token:
                count[f] = count.get(f, 0) + 1
    ids = {f: i for i, f in enumerate(sorted(f for f, c in count.items() if c > 1))}
    n = len(sequences)
    flat, at, label = array("q"), array("q"), np.zeros((CHAIN, n))  # arrays: lists of numbers take ten times the memory
    real = np.zeros((CHAIN, n), dtype=bool)
    for j, (seq, marks) in enumerate(sequences):
        for k, token in enumerate(seq[:CHAIN]):
            real[k, j] = True
            label[k, j] = marks[k]
            for f in token:
                if f in ids:
                    flat.append(ids[f])
                    at.append(k * n + j)
    flat_a, at_a = (np.frombuffer(x, dtype=np.int64) if len(x) else np.zeros(0, dtype=np.int64) for x in (flat, at))
    w, bias, move = np.zeros(len(ids)), -4.0, np.zeros(4)
    pairs, size = real[1:], real.sum(axis=0)
    seen = np.array([((label[:-1] == a) & (label[1:] == b) & pairs).sum() for a in (0, 1) for b in (0, 1)], dtype=float)
    speed: list[np.ndarray] = [np.zeros(len(ids)), np.zeros(1), np.zeros(4)]
    square: list[np.ndarray] = [np.zeros(len(ids)), np.zeros(1), np.zeros(4)]
    for t in range(1, rounds + 1):
        grid = np.bincount(at_a, weights=w[flat_a], minlength=CHAIN * n).reshape(CHAIN, n) + bias * real
        p, fwd, bwd = marginals(grid, move, size)
        off = np.where(real, label - p, 0.0)
        # expected moves between neighbours, from both messages
        e = np.stack([np.zeros_like(fwd[:-1]) + move[0], bwd[1:] + grid[1:] + move[1], fwd[:-1] + move[2],
                      fwd[:-1] + bwd[1:] + grid[1:] + move[3]])
        e = np.exp(e - e.max(axis=0))
        e /= e.sum(axis=0)
        expected = (e * pairs).reshape(4, -1).sum(axis=1)
        grads = [np.bincount(flat_a, weights=off.ravel()[at_a], minlength=len(ids)) - l2 * w,
                 np.array([off.sum()]), seen - expected - l2 * move]
        for g, s, q, rate, x in zip(grads, speed, square, (0.15, 0.15, 0.05), (w, None, move)):
            s *= 0.9
            s += 0.1 * g
            q *= 0.99
            q += 0.01 * g * g
            step = rate * (s / (1 - 0.9**t)) / (np.sqrt(q / (1 - 0.99**t)) + 1e-6)
            if x is None:
                bias += float(step[0])
            else:
                x += step
    return Model({f: float(w[i]) for f, i in ids.items() if abs(w[i]) > 1e-3}, bias, tuple(float(x) for x in move))


class Tagger:
    """Applies a model to texts, remembering the scores of frequent tokens."""

    def __init__(self, model: Model):
        self.model = model
        self.cutter = Cutter(model.inside)
        self.known: dict[bytes, tuple[float, ...]] = {}

    def score(self, token: str) -> float:
        weight = self.model.weights.get
        return self.model.bias + sum([weight(f, 0.0) for f in features(token)])

    def scores(self, stretch: bytes) -> tuple[float, ...]:
        """Scores of the tokens of a stretch."""
        got = tuple(map(self.score, self.cutter.cut(stretch.decode())))
        if len(self.known) >= REMEMBERED:
            self.known.clear()
        if len(stretch) <= LONGEST:
            self.known[stretch] = got
        return got

    def totals(self, texts: list[str | None], budget: int = 2_000_000) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
        """Blocks of texts of at most about ``budget`` characters: totals, marginals and the number of texts."""
        at = 0
        while at < len(texts):
            size, to = 0, at
            while to < len(texts) and (to == at or size + len(texts[to] or "") <= budget):
                size += len(texts[to] or "")
                to += 1
            yield (*self.block(texts[at:to]), to - at)
            at = to

    def block(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Per text the number of tokens, the largest log odds and the sums that the score is made of; and all marginals."""
        known, scores = self.known, self.scores
        values: list[float] = []
        lengths = np.zeros(len(texts), dtype=np.int64)
        for i, text in enumerate(texts):
            if text:
                found = stretches(text)
                got = list(map(known.get, found))
                if None in got:
                    got = [scores(t) if v is None else v for t, v in zip(found, got)]
                before = len(values)
                values.extend(chain.from_iterable(got))
                lengths[i] = len(values) - before
        if not values:
            return np.zeros((len(texts), 3)), np.zeros(0)
        grid, step, column = chains(np.array(values), lengths)
        follows = np.ones(grid.shape[1], dtype=bool)
        follows[column[(np.cumsum(lengths) - lengths)[lengths > 0]]] = False
        p, _, _ = marginals(grid, self.model.move, np.bincount(column), follows)
        p = np.clip(p[step, column], 1e-9, 1 - 1e-9)
        ends = np.cumsum(lengths)
        out = np.zeros((len(texts), 3))
        full = np.flatnonzero(lengths)
        starts = (ends - lengths)[full]
        out[full, 0] = np.maximum.reduceat(p, starts)
        out[full, 1] = np.add.reduceat(np.where(p > 0.2, p, 0.0), starts)
        out[full, 2] = lengths[full]
        return out, p

    def evidence(self, totals: np.ndarray) -> np.ndarray:
        """Document features: the strongest token's log odds, the amount of toxic tokens and their share."""
        top = np.where(totals[:, 2] > 0, totals[:, 0], 1e-9)
        top = np.clip(top, 1e-9, 1 - 1e-9)
        return np.stack([np.log(top / (1 - top)) / 5, np.log1p(totals[:, 1]),
                         np.sqrt(totals[:, 1] / np.maximum(totals[:, 2], 1))], axis=1)

    def doc_score(self, totals: np.ndarray) -> np.ndarray:
        if not self.model.doc:
            return np.zeros(len(totals))
        x = self.evidence(totals) @ np.array(self.model.doc[1:]) + self.model.doc[0]
        return 1 / (1 + np.exp(-np.clip(x, -50, 50)))

    def spans(self, text: str, p: np.ndarray) -> list[dict]:
        """Offsets in code points of runs of toxic tokens."""
        out: list[dict] = []
        last, k = -2, 0
        for m in RUN.finditer(text):
            start = m.start()
            for size in self.cutter.sizes(m.group()):
                if p[k] >= SPAN_MARGINAL:
                    if last == k - 1:
                        out[-1]["end"] = start + size
                    else:
                        out.append({"start": start, "end": start + size})
                    last = k
                start += size
                k += 1
        return out


def fit_score(x: np.ndarray, y: np.ndarray, rounds: int = 60, l2: float = 0.05) -> tuple[float, ...]:
    """Logistic weights (constant first) by Newton steps."""
    a = np.concatenate([np.ones((len(x), 1)), x], axis=1)
    w = np.zeros(a.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        g = a.T @ (y - p) - l2 * w
        h = (a * (p * (1 - p))[:, None]).T @ a + l2 * np.eye(len(w))
        step = np.linalg.solve(h, g)
        w += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-6:
            break
    return tuple(float(v) for v in w)


def count_cues(rows: Iterable[tuple[str | None, int]], most: int = 300_000) -> Iterator[dict[str, tuple[int, int]]]:
    """Numbers of toxic and clean documents with each cue; a part whenever the table is large."""
    seen: dict[str, list[int]] = {}
    cutter = Cutter()
    for text, toxic in rows:
        for f in {f for t in set(cutter.tokens(text)) for f in cues(t)}:
            seen.setdefault(f, [0, 0])[0 if toxic else 1] += 1
        if len(seen) > most:
            yield {k: (v[0], v[1]) for k, v in seen.items()}
            seen = {}
    yield {k: (v[0], v[1]) for k, v in seen.items()}


def windows(text: str | None, toxic: int, strong: frozenset[str], cutter: Cutter, most: int = 3,
            width: int = CHAIN) -> list[tuple[list[str], list[int]]]:
    """Labelled chains of one document, ``most`` at most: around cues in toxic texts, drawn by hash from the whole text in clean ones."""
    tokens = cutter.tokens(text)
    if not tokens:
        return []
    marks = [int(bool(toxic) and not strong.isdisjoint(cues(t))) for t in tokens]
    hits = [k for k, m in enumerate(marks) if m]
    if hits:
        begins = [max(0, k - width // 2) for k in hits[:: max(1, len(hits) // most)][:most]]
    else:
        seed = zlib.crc32((text or "").encode("utf-8", "replace"))
        last = max(len(tokens) - width, 0)
        begins = sorted({zlib.crc32(f"{seed}:{k}".encode()) % (last + 1) for k in range(min(most, 1 + last // width))})
    return [(tokens[b:b + width], marks[b:b + width]) for b in begins]


def learnable(labels: DataFrame, id_col: str, label_col: str, max_labelled: int) -> DataFrame:
    """At most ``max_labelled`` labelled ids outside the held-out fold, up to half of them toxic, the same on any cluster."""
    rows = (labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("y"))
            .filter(F.col("y").isin(0, 1) & F.col("id").isNotNull() & ~common.held_out("id"))
            .groupBy("id").agg(F.max("y").alias("y")))
    order = [F.xxhash64("id"), "id"]
    return (rows.filter("y = 1").orderBy(*order).limit(max_labelled // 2)
            .union(rows.filter("y = 0").orderBy(*order).limit(max_labelled // 2)))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
          max_labelled: int = 16_000, max_chains: int = 6_000, min_docs: int = 3, min_lift: float = 15.0,
          max_cues: int = 20_000, windows_per_document: int = 3) -> Model:
    """Fit the model to labelled documents outside the held-out fold.

    Bounds: ``max_labelled`` documents, whose whole texts are read for cues and
    for the calibration; ``max_cues`` cues, those in most toxic documents first;
    ``windows_per_document`` chains of 64 tokens a document and ``max_chains`` in
    all for the chain's weights.
    """
    common.ship(docs.sparkSession)
    ids = F.broadcast(learnable(labels, id_col, label_col, max_labelled))
    sample = common.shared(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
                           .filter(F.col("text").isNotNull()).join(ids, "id").select("id", "text", "y"))
    size = {r["y"]: r["n"] for r in sample.groupBy("y").agg(F.count("*").alias("n")).collect()}
    n_toxic, n_clean = size.get(1, 0), size.get(0, 0)
    if not n_toxic or not n_clean:
        return Model()

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = ((t, y) for b in batches for t, y in zip(b.column("text").to_pylist(), b.column("y").to_pylist()))
        for part in count_cues(rows):
            yield pa.RecordBatch.from_pydict({"cue": list(part), "toxic": [v[0] for v in part.values()],
                                              "clean": [v[1] for v in part.values()]})

    lift = (F.col("toxic") / F.lit(float(n_toxic))) / ((F.col("clean") + 0.5) / F.lit(float(n_clean)))
    strong = frozenset(r["cue"] for r in (
        sample.mapInArrow(counted, "cue string, toxic long, clean long").groupBy("cue")
        .agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
        .filter((F.col("toxic") >= min(min_docs, max(1, n_toxic // 2))) & (lift >= min_lift))
        .orderBy(F.desc("toxic"), "cue").limit(max_cues).select("cue").collect()))
    inside = tuple(sorted(c[2:] for c in strong if c.startswith("w=") and len(c) >= 2 + INSIDE))

    def labelled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cutter = Cutter(inside)
        for b in batches:
            got = [(i, y, s, m) for i, t, y in zip(b.column("id").to_pylist(), b.column("text").to_pylist(), b.column("y").to_pylist())
                   for s, m in windows(t, y, strong, cutter, windows_per_document)]
            if got:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([str(x[0]) for x in got]), pa.array([x[1] for x in got], pa.int32()),
                     pa.array([x[2] for x in got], pa.list_(pa.string())), pa.array([x[3] for x in got], pa.list_(pa.int32()))],
                    ["id", "y", "tokens", "marks"])

    chosen = sample.mapInArrow(labelled, "id string, y int, tokens array<string>, marks array<int>")
    marked = F.exists("marks", lambda m: m == 1)
    order = [F.xxhash64("id", "tokens"), "id"]
    rows = (chosen.filter(marked).orderBy(*order).limit(max_chains // 2)
            .union(chosen.filter((F.col("y") == 0)).orderBy(*order).limit(max_chains // 2))).select("tokens", "marks").collect()
    of: dict[str, list[str]] = {}  # one list per distinct token, not per token
    model = fit_chain([([of.get(t) or of.setdefault(t, features(t)) for t in r["tokens"]], r["marks"]) for r in rows]) if rows else Model()
    model.inside = inside
    del rows, of

    def totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tagger = Tagger(model)
        for b in batches:
            t = np.concatenate([x[0] for x in tagger.totals(b.column("text").to_pylist())]) if b.num_rows else np.zeros((0, 3))
            yield pa.RecordBatch.from_arrays([b.column("y"), *[pa.array(t[:, k]) for k in range(3)]], ["y", "a", "b", "c"])

    got = sample.mapInArrow(totals, "y int, a double, b double, c double").collect()
    t = np.array(sorted(map(tuple, got)), dtype=float).reshape(-1, 4)
    model.doc = fit_score(Tagger(model).evidence(t[:, 1:]), t[:, 0])
    return model


def score(docs: DataFrame, model: Model, text_col: str = "text", threshold: float = THRESHOLD, only_clean: bool = False) -> DataFrame:
    """``docs`` with ``toxic_score``, ``toxic_spans`` (start and end in code points) and ``is_toxic``.

    ``only_clean`` leaves toxic documents out, in the task; a column of ``docs`` named like a result
    then stays as it is, in the result's place.
    """
    if only_clean:
        taken = {f.name for f in FIELDS} | {"clean"}
        aside = {c: f"__own_{k}" for k, c in enumerate(docs.columns) if c.lower() in taken}
        found = score_kept(docs.withColumnsRenamed(aside), model, text_col, threshold)
        return common.without(found, *aside).withColumnsRenamed({v: k for k, v in aside.items()})
    return common.annotate(docs, text_col, scorer(docs, model, threshold), FIELDS)


def score_kept(docs: DataFrame, model: Model, text_col: str, threshold: float) -> DataFrame:
    """Scored rows that are not toxic."""
    out = common.annotate(docs, text_col, scorer(docs, model, threshold), [*FIELDS, T.StructField("clean", T.BooleanType())], keep="clean")
    return common.without(out, "clean")


def scorer(docs: DataFrame, model: Model, threshold: float) -> Callable[[], Callable[[pa.Array], dict[str, pa.Array]]]:
    """What :func:`common.annotate` runs in a task."""
    packed = docs.sparkSession.sparkContext.broadcast(model)

    def make() -> Callable[[pa.Array], dict[str, pa.Array]]:
        tagger = Tagger(packed.value)

        def work(column: pa.Array) -> dict[str, pa.Array]:
            texts = column.to_pylist()
            scores, spans, at = [], [], 0
            for totals, p, n in tagger.totals(texts):
                scores.append(tagger.doc_score(totals))
                first = 0
                for i in range(n):
                    k = int(totals[i, 2])
                    spans.append(tagger.spans(texts[at + i], p[first:first + k]) if totals[i, 0] >= SPAN_MARGINAL else [])
                    first += k
                at += n
            s = np.concatenate(scores) if scores else np.zeros(0)
            return {"toxic_score": pa.array(s), "toxic_spans": pa.array(spans, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
                    "is_toxic": pa.array(s >= threshold), "clean": pa.array(s < threshold)}

        return work

    return make


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score every document of ``documents``."""
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text")
    model = train(docs, common.table(spark, sf_dir, "labels"))
    return score(docs, model).select(
        "doc_id", common.held_out().alias("held_out"), F.col("toxic_score").alias("score"),
        F.col("is_toxic").cast("int").alias("predicted"),
        F.transform("toxic_spans", lambda s: F.concat_ws(":", s["start"], s["end"])).alias("spans"))
