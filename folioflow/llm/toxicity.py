"""Toxic spans and documents by a linear-chain conditional random field.

Tokens are runs of letters, lower-cased one by one. Each is tagged toxic or not; a
token's features are the token, its stems (its first 4, 5 and 6 letters, where more
follow), and the previous and the next token. Documents carry labels, tokens do not,
so tokens of the labelled sample are labelled first: a token or stem is picked if the
share of toxic documents among those that have it is at least ``LEAST_PRECISION`` at
the low end of its confidence interval, and if so many toxic ones are not to be
expected by chance from all units together; near copies count once. What was picked
is toxic in toxic documents; all tokens of other documents are not. The field is then
trained on these sequences by gradient ascent, with forward-backward in numpy, over a
bounded sample of labelled rows: at most ``MOST_DOCS`` of each label and
``MOST_CHARS`` characters in all, drawn by the hash of doc_id, whole texts only.

Every token of every text is scored, and a text is one chain. The recursions run over
stretches of ``SEGMENT`` tokens side by side, one vector operation a step. What enters
a stretch comes from the stretch before: products of the steps' matrices carry it
over all stretches of a text, so the marginals are those of the whole chain. A
document's score comes from its largest marginal, the sum of its marginals and its
length, by a logistic curve fitted on the sample's labels. Tokens with a marginal of
0.5 or more give its spans, as character offsets in the text as it is.

Defined cases: null and empty texts, and texts without letters, get the score of a
document without any toxic token; labels of null or repeated doc_ids: null ones are
not used, of several the largest counts; of texts that share a doc_id the one with the
smallest hash is learned from; without labelled rows of both kinds all scores are 0;
repeated rows repeat; an empty table gives an empty result; extra columns are ignored,
and kept by ``clean``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioflow.llm.common import id_bucket

FOLDS, HELD_OUT = 5, 0
MOST_DOCS = 1500
MOST_CHARS = 8_000_000
LEAST_PRECISION = 0.6
#: Standard deviations from a share to the low end of its interval.
DEVIATIONS = 1.3
#: Units that chance alone may be expected to pick.
BY_CHANCE = 2
BANDS = 5
STEMS = (4, 5, 6)
#: Tokens whose weights a worker remembers; it starts anew when there are more.
MEMORY_TOKENS = 400_000
SEGMENT = 64
#: Tokens that are scored, or trained on, at a time; more where one text has more.
PART = 1 << 17
ROUNDS = 40
TOKEN = re.compile(r"[^\W\d_]+")
_ASCII_TOKEN = re.compile("[A-Za-z]+")


def tokens(text: str | None) -> list[str]:
    """The tokens of a text as they stand there."""
    text = text or ""
    return (_ASCII_TOKEN if text.isascii() else TOKEN).findall(text)


def units(word: str) -> list[str]:
    """The token itself, lower-cased, and its stems."""
    word = word.lower()
    return [word, *[word[:n] + "*" if len(word) > n else "" for n in STEMS]]


def sample(docs: DataFrame, labels: DataFrame, most_docs: int = MOST_DOCS, most_chars: int = MOST_CHARS) -> list[tuple[str, int, float]]:
    """A bounded sample of (text, label, rows that it stands for), outside the held-out fold."""
    known = labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    known = known.where(id_bucket(F.col("doc_id"), FOLDS) != HELD_OUT).select(F.col("doc_id").cast("long").alias("doc_id"), "toxic")
    lengths = docs.where("text is not null and doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), F.length("text").alias("n"))
    # Ids that repeat count once: they would fill the sample with one text.
    both = lengths.join(known, "doc_id").groupBy("doc_id", "toxic").agg(F.max("n").alias("n")).withColumn("h", F.xxhash64("doc_id"))
    there = {r.toxic: r.n for r in both.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    chosen: dict[int, int] = {}
    for label in (1, 0):
        chars = 0
        for row in both.where(F.col("toxic") == label).orderBy("h", "doc_id").limit(most_docs).collect():
            chars += row.n
            if chars <= most_chars // 2:
                chosen[row.doc_id] = label
            else:
                chars -= row.n
    if not chosen:
        return []
    some = docs.where(F.col("doc_id").isin(list(chosen)) & F.col("text").isNotNull()).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = some.groupBy("doc_id").agg(F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text")).collect()
    stands = {y: there[y] / sum(1 for v in chosen.values() if v == y) for y in set(chosen.values())}
    return [(r.text or "", chosen[r.doc_id], stands[chosen[r.doc_id]]) for r in sorted(rows, key=lambda r: r.doc_id)]


def _spread(ids: np.ndarray, salt: int) -> np.ndarray:
    """Numbers mixed well, another way for each salt."""
    x = (ids.astype(np.uint64) + np.uint64(salt + 1)) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def families(bags: list[np.ndarray], n_units: int) -> list[int]:
    """A family number per text; near copies share one, so that each text counts once.

    Texts, as distinct token numbers, of a family agree in a band of three smallest
    hashes of their rare tokens.
    """
    seen = np.zeros(n_units, dtype=np.int32)
    for bag in bags:
        seen[bag] += 1
    parent = list(range(len(bags)))

    def find(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    first: dict[tuple[int, ...], int] = {}
    for i, bag in enumerate(bags):
        rare = bag[seen[bag] <= 0.01 * len(bags)]
        if not len(rare):
            continue
        lows = [int(_spread(rare, h).min()) for h in range(3 * BANDS)]
        for band in range(BANDS):
            parent[find(i)] = find(first.setdefault((band, *lows[3 * band : 3 * band + 3]), i))
    return [find(i) for i in range(len(bags))]


def toxic_units(texts: list[np.ndarray], labels: list[int], n_units: int, clean: float = 1.0) -> np.ndarray:
    """Which units (tokens and stems) mark toxic documents (see above).

    ``texts`` are unit numbers of (token, unit); 0 is none. A clean text of the sample
    stands for ``clean`` times as many as a toxic one.
    """
    groups: dict[tuple[int, int], list[np.ndarray]] = {}
    for family, t, y in zip(families([np.unique(t[:, 0]) for t in texts], n_units), texts, labels):
        groups.setdefault((family, y), []).append(np.unique(t))
    seen = np.zeros((2, n_units))
    size = np.zeros(2)
    for (_, y), members in groups.items():
        seen[y, np.unique(np.concatenate(members))] += 1
        size[y] += 1
    # Half a clean text more: not seen in a small part of the clean ones is not rare.
    k, n, z = seen[1], seen[1] + clean * (seen[0] + 0.5), DEVIATIONS
    p = k / n
    # Lower end of the Wilson interval of k in n.
    bound = (p + z * z / (2 * n) - z * np.sqrt(p * (1 - p) / n + z * z / (4 * n * n))) / (1 + z * z / n)
    # Chernoff's bound of the chance that a unit which says nothing has so many toxic texts.
    usual = size[1] / size.sum()
    q = np.clip(k / np.maximum(1, seen.sum(axis=0)), 1e-12, 1 - 1e-12)
    apart = np.where(q > usual, q * np.log(q / usual) + (1 - q) * np.log((1 - q) / (1 - usual)), 0.0)
    total = seen.sum(axis=0).astype(int)
    # Units with fewer texts could not get that far.
    rivals = np.cumsum(np.bincount(total)[::-1])[::-1][total]
    expected = rivals * np.exp(-total * apart)
    picked = (bound >= LEAST_PRECISION) & (expected <= BY_CHANCE)
    picked[0] = False
    return picked


class Chains:
    """Texts of some lengths, cut to stretches of ``SEGMENT`` tokens that lie side by side.

    Values of all tokens in a row (``flat``) become arrays of (SEGMENT, stretch).
    """

    def __init__(self, lengths: np.ndarray) -> None:
        self.lengths = np.asarray(lengths, dtype=np.int64)
        self.n = int(self.lengths.sum())
        per = -(-self.lengths // SEGMENT)
        #: Text, place within the text, and number of tokens of each stretch.
        self.text = np.repeat(np.arange(len(per)), per)
        self.place = np.arange(len(self.text)) - np.repeat(np.cumsum(per) - per, per)
        self.held = np.minimum(SEGMENT, self.lengths[self.text] - SEGMENT * self.place)
        start = (np.cumsum(self.lengths) - self.lengths)[self.text] + SEGMENT * self.place
        self.at = start[None, :] + np.arange(SEGMENT)[:, None]
        self.on = np.arange(SEGMENT)[:, None] < self.held[None, :]
        self.of_token = np.repeat(np.arange(len(self.lengths)), self.lengths)
        #: Whether a token and the next one are of one text.
        self.joined = self.of_token[1:] == self.of_token[:-1]
        self.first = self.place == 0
        self.last = self.place == per[self.text] - 1

    def wide(self, flat: np.ndarray, other: float) -> np.ndarray:
        out = np.full(self.on.shape, other, dtype=float)
        out[self.on] = flat[self.at[self.on]]
        return out

    def flat(self, wide: np.ndarray) -> np.ndarray:
        out = np.empty(self.n)
        out[self.at[self.on]] = wide[self.on]
        return out

    def entering(self, w: np.ndarray, a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """What each stretch gets from the one before and from the one after, as odds; the outermost get none."""
        fore, back = np.ones(len(self.text)), np.ones(len(self.text))
        many = np.flatnonzero(~(self.first & self.last))
        if not len(many):
            return fore, back
        # The product of the matrices of all steps of a stretch, scaled: row i is what state i before it becomes.
        w, on = w[:, many], self.on[:, many]
        m = np.empty((2, 2, len(many)))
        m[0], m[1] = [[1.0], [0.0]], [[0.0], [1.0]]
        for k in range(SEGMENT):
            new = np.stack([m[:, 0] * a[0, 0] + m[:, 1] * a[1, 0], (m[:, 0] * a[0, 1] + m[:, 1] * a[1, 1]) * w[k]], axis=1)
            m = np.where(on[k], new / new.sum(axis=(0, 1)), m)
        place, last = self.place[many], self.last[many]
        # Stretches of all texts that have so many move on together.
        for k in range(1, int(place.max()) + 1):
            here = np.flatnonzero(place == k)
            before = here - 1
            # The first stretch begins without a step; its own forward odds are in ``begun``.
            x = np.where(place[before] == 0, self.begun[many[before]], 0.0)
            o = fore[many[before]]
            t = (m[0, 1][before] + o * m[1, 1][before]) / (m[0, 0][before] + o * m[1, 0][before])
            fore[many[here]] = np.where(place[before] == 0, x, t)
        for k in range(int(place.max()) - 1, -1, -1):
            here = np.flatnonzero((place == k) & ~last)
            after = here + 1
            o = back[many[after]]
            back[many[here]] = (m[1, 0][after] + m[1, 1][after] * o) / (m[0, 0][after] + m[0, 1][after] * o)
        return fore, back

    def odds(self, w: np.ndarray, s: np.ndarray, a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Forward and backward odds of the toxic tag at every token (SEGMENT, stretch).

        Only the odds of the two states matter, so each recursion is one fraction a step.
        """

        def forward(r: np.ndarray, k: int) -> np.ndarray:
            return w[k] * (a[0, 1] + r * a[1, 1]) / (a[0, 0] + r * a[1, 0])

        r, q = np.empty(w.shape), np.ones(w.shape)
        # First stretches of long texts go first: their ends are what second ones begin with.
        self.begun = np.ones(len(self.text))
        long = np.flatnonzero(self.first & ~self.last)
        if len(long):
            x = s[1] / s[0] * w[0, long]
            for k in range(1, SEGMENT):
                x = w[k, long] * (a[0, 1] + x * a[1, 1]) / (a[0, 0] + x * a[1, 0])
            self.begun[long] = x
        fore, back = self.entering(w, a)
        r[0] = np.where(self.first, s[1] / s[0] * w[0], forward(fore, 0))
        for k in range(1, SEGMENT):
            r[k] = forward(r[k - 1], k)
        ends = self.held - 1
        for k in range(SEGMENT - 1, -1, -1):
            if k + 1 < SEGMENT:
                y = w[k + 1] * q[k + 1]
                inner = (a[1, 0] + a[1, 1] * y) / (a[0, 0] + a[0, 1] * y)
            else:
                inner = back
            q[k] = np.where(ends == k, back, np.where(self.on[k], inner, 1.0))
        return r, q


class Field:
    """The trained field: a vocabulary, emission weights of three positions, transitions."""

    def __init__(self, vocabulary: dict[str, int]) -> None:
        self.vocabulary = vocabulary
        n = len(vocabulary) + 1
        self.own, self.before, self.after = np.zeros(n), np.zeros(n), np.zeros(n)
        self.bias = -3.0
        self.start = np.array([0.0, -1.0])
        self.step = np.array([[0.0, -1.0], [0.0, 0.0]])
        self.curve = np.zeros(4)

    def ids(self, words: list[str]) -> np.ndarray:
        """The numbers of each token and its stems, (token, unit)."""
        get = self.vocabulary.get
        return np.array([[get(u, 0) for u in units(w)] for w in words], dtype=np.int32).reshape(len(words), 1 + len(STEMS))

    def emissions(self, own: np.ndarray, before: np.ndarray, after: np.ndarray, chains: Chains) -> np.ndarray:
        """Score of the toxic tag over the other one of all tokens, from the weights that each brings along."""
        e = own + self.bias
        e[1:] += before[:-1] * chains.joined
        e[:-1] += after[1:] * chains.joined
        return np.clip(e, -30, 30)

    def of_ids(self, ids: np.ndarray, chains: Chains) -> np.ndarray:
        """The same from ids of (token, unit)."""
        return self.emissions(self.own[ids].sum(axis=1), self.before[ids[:, 0]], self.after[ids[:, 0]], chains)

    def known(self) -> _Weights:
        if not hasattr(self, "_known") or len(self._known) > MEMORY_TOKENS:
            self._known = _Weights(self)
        return self._known

    def marginals(self, e: np.ndarray, chains: Chains) -> np.ndarray:
        """Probability of the toxic tag of every token, by forward-backward over whole texts."""
        return self._tagged(e, chains)[0]

    def _tagged(self, e: np.ndarray, chains: Chains, pairs: bool = False) -> tuple[np.ndarray, np.ndarray | None]:
        s, a = np.exp(self.start), np.exp(self.step)
        w = chains.wide(np.exp(e), 1.0)
        r, q = chains.odds(w, s, a)
        odds = chains.flat(r * q)
        p = odds / (1 + odds)
        if not pairs:
            return p, None
        # Expected numbers of the tags of neighbours.
        both = np.empty((2, 2))
        r, y = chains.flat(r)[:-1][chains.joined], chains.flat(w * q)[1:][chains.joined]
        cells = [[a[0, 0], a[0, 1] * y], [r * a[1, 0], r * a[1, 1] * y]]
        z = cells[0][0] + cells[0][1] + cells[1][0] + cells[1][1]
        for i in (0, 1):
            for j in (0, 1):
                both[i, j] = (cells[i][j] / z).sum()
        return p, both

    def train(self, texts: list[np.ndarray], tags: list[np.ndarray], rounds: int = ROUNDS) -> None:
        """Gradient ascent on the log-likelihood with adaptive steps; a text is ids of (token, unit)."""
        n = len(self.own)
        parts = []
        for some in _batches([len(t) for t in texts]):
            chains = Chains(np.array([len(texts[i]) for i in some]))
            parts.append((chains, np.concatenate([texts[i] for i in some]), np.concatenate([tags[i] for i in some])))
        seen = np.zeros((2, 2))
        for chains, _, g in parts:
            for i in (0, 1):
                for j in (0, 1):
                    seen[i, j] += ((g[:-1] == i) & (g[1:] == j) & chains.joined).sum()
        speed = {k: 1e-8 for k in ("own", "before", "after", "bias", "start", "step")}
        for _ in range(rounds):
            grads = {"own": -0.05 * self.own, "before": -self.before, "after": -self.after, "bias": 0.0, "start": np.zeros(2), "step": seen.copy()}
            # In parts, so that the recursion's arrays stay small.
            for chains, ids, g in parts:
                p, both = self._tagged(self.of_ids(ids, chains), chains, pairs=True)
                gap = g - p
                for u in range(ids.shape[1]):
                    grads["own"] += np.bincount(ids[:, u], gap, n)
                grads["before"] += np.bincount(ids[:-1, 0], gap[1:] * chains.joined, n)
                grads["after"] += np.bincount(ids[1:, 0], gap[:-1] * chains.joined, n)
                grads["bias"] += gap.sum()
                begin = gap[np.append(True, ~chains.joined)].sum() if len(gap) else 0.0
                grads["start"] += [-begin, begin]
                grads["step"] -= both
            for w in ("own", "before", "after"):
                grads[w][0] = 0.0
            for k, g in grads.items():
                speed[k] = speed[k] + g * g
                setattr(self, k, getattr(self, k) + 0.6 * g / np.sqrt(speed[k]))

    def calibrate(self, signs: np.ndarray, labels: np.ndarray, weight: np.ndarray) -> None:
        """Fits the document score to the signs of texts (see ``_signs``), by Newton steps."""
        x, weight = _design(signs), weight / weight.mean()
        w, ridge = np.zeros(x.shape[1]), np.diag([1e-2, 1e-2, 1e-2, 1e-4])
        for _ in range(100):
            q = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
            h = (x * (weight * np.maximum(q * (1 - q), 1e-6))[:, None]).T @ x + ridge
            w -= 0.5 * np.linalg.solve(h, x.T @ (weight * (q - labels)) + ridge @ w)
        self.curve = w

    def score(self, signs: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(_design(signs) @ self.curve, -30, 30)))


def _batches(lengths: list[int]) -> Iterator[list[int]]:
    """Texts in a row that have about ``PART`` tokens together."""
    some, size = [], 0
    for i, n in enumerate(lengths):
        if some and size + n > PART:
            yield some
            some, size = [], 0
        some.append(i)
        size += n
    if some:
        yield some


def _signs(p: np.ndarray, chains: Chains) -> np.ndarray:
    """Largest marginal, sum of the marginals and number of tokens of each text."""
    n = len(chains.lengths)
    top = np.zeros(n)
    np.maximum.at(top, chains.of_token, p)
    return np.stack([top, np.bincount(chains.of_token, p, n), chains.lengths], axis=1)


def _design(signs: np.ndarray) -> np.ndarray:
    top = np.clip(signs[:, 0], 1e-4, 1 - 1e-4)
    return np.stack([np.log(top / (1 - top)), np.log1p(signs[:, 1]), np.log1p(signs[:, 2]), np.ones(len(signs))], axis=1)


class _Weights(dict):
    """Row numbers of tokens in a table of (own, before, after) weights; filled as tokens come."""

    def __init__(self, field: Field) -> None:
        super().__init__()
        self.field, self.rows = field, [(0.0, 0.0, 0.0)]

    def __missing__(self, word: str) -> int:
        f, get = self.field, self.field.vocabulary.get
        i = get(word, 0)
        self.rows.append((float(sum(f.own[get(u, 0)] for u in units(word))), float(f.before[i]), float(f.after[i])))
        self[word] = len(self.rows) - 1
        return len(self.rows) - 1

    def table(self) -> np.ndarray:
        if getattr(self, "held", (0,))[0] != len(self.rows):
            self.held = (len(self.rows), np.array(self.rows).T.copy())
        return self.held[1]


def train(rows: list[tuple[str, int, float]]) -> Field | None:
    """The field of a labelled sample; none without both labels."""
    labels = [int(bool(y)) for _, y, _ in rows]
    if len(set(labels)) < 2:
        return None
    # Units get numbers at once; strings of all tokens would take too much of the driver.
    number: dict[str, int] = {"": 0}
    texts = []
    for text, _, _ in rows:
        flat = [number.setdefault(u, len(number)) for w in tokens(text) for u in units(w)]
        texts.append(np.array(flat, dtype=np.int32).reshape(-1, 1 + len(STEMS)))
    weight = np.array([w for _, _, w in rows])
    stands = {y: weight[[x == y for x in labels]].mean() for y in (0, 1)}
    toxic = toxic_units(texts, labels, len(number), stands[0] / stands[1])
    counts = np.zeros(len(number), dtype=np.int32)
    for t in texts:
        counts[np.unique(t)] += 1
    kept = (counts >= 3) | toxic
    kept[0] = False
    renumber = np.where(kept, np.cumsum(kept), 0).astype(np.int32)
    field = Field({u: int(renumber[i]) for u, i in number.items() if kept[i]})
    del number
    tags = [toxic[t].any(axis=1).astype(np.int8) * y for t, y in zip(texts, labels)]
    texts = [renumber[t] for t in texts]
    field.train(texts, tags)
    signs = []
    for some in _batches([len(t) for t in texts]):
        chains = Chains(np.array([len(texts[i]) for i in some]))
        signs.append(_signs(field.marginals(field.of_ids(np.concatenate([texts[i] for i in some]), chains), chains), chains))
    field.calibrate(np.concatenate(signs), np.array(labels, dtype=float), weight)
    return field


def _score_texts(field: Field | None, texts: list[str | None], spans: bool) -> tuple[np.ndarray, list[list[dict]]]:
    """Scores and toxic spans of some texts."""
    found: list[list[dict]] = [[] for _ in texts]
    if field is None or not texts:
        return np.zeros(len(texts)), found
    known = field.known()
    rows = [np.array(list(map(known.__getitem__, tokens(t))), dtype=np.int32) for t in texts]
    table, signs = known.table(), []
    for some in _batches([len(r) for r in rows]):
        chains = Chains(np.array([len(rows[i]) for i in some]))
        ids = np.concatenate([rows[i] for i in some])
        p = field.marginals(field.emissions(table[0][ids], table[1][ids], table[2][ids], chains), chains)
        signs.append(_signs(p, chains))
        hot = np.flatnonzero(p >= 0.5) if spans else ()
        if len(hot):
            start = np.cumsum(chains.lengths) - chains.lengths
            for k in np.unique(chains.of_token[hot]).tolist():
                at = [m.span() for m in TOKEN.finditer(texts[some[k]] or "")]
                found[some[k]] = [{"start": at[x][0], "end": at[x][1]} for x in (hot[chains.of_token[hot] == k] - start[k]).tolist()]
    return field.score(np.concatenate(signs)), found


SCORES = "doc_id long, score double, spans array<struct<start:int,end:int>>"


def scored(docs: DataFrame, field: Field | None, spans: bool = True) -> DataFrame:
    """(doc_id, score, spans) for every row of ``docs``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _slices(batch):
                score, found = _score_texts(field, part.column(1).to_pylist(), spans)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(score), pa.array(found, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))], names=["doc_id", "score", "spans"]
                )

    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return plain.mapInArrow(run, SCORES)


def _slices(batch: pa.RecordBatch, rows: int = 256) -> Iterator[pa.RecordBatch]:
    for at in range(0, batch.num_rows, rows):
        yield batch.slice(at, rows)


def clean(docs: DataFrame, field: Field | None, threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` whose score stays below ``threshold``, all columns as they were."""
    schema = docs.schema
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _slices(batch):
                score, _ = _score_texts(field, part.column(at).to_pylist(), False)
                yield part.filter(pa.array(score < threshold))

    return docs.mapInArrow(run, schema)
