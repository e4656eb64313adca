"""Secrets in texts: fixed patterns, and spans a linear-chain CRF adds.

The base spans are the leftmost non-overlapping matches of each pattern. The CRF
tags tokens as begin, inside or outside of a secret. Its features are a token's
shape, the shapes and words beside it, whether a word of the key kind or an
assignment sign stands shortly before, and two of the whole file: how many tokens
with digits it has for its length, and its length. It learns from a bounded
sample of documents with base spans (all tokens of the values are the secrets) and
without, and is decoded by Viterbi. Base values mostly have digits and a key word
before them, so each is also learned from as a twin of letters or letters and
symbols only, with and without the key word; documents without base spans get such
twins too.

Every token's scores are added up. Where ``outside`` leads another tag by more than
transitions to and from that tag could give back, no best path has that tag. Tokens
that can only be outside cut the chain, and the stretches between them are decoded:
the same tags as over the whole text.

Defined results: a null text counts as empty and has no spans; offsets count code
points, ends are exclusive; repeated rows each give a row; an empty table gives
none; other columns, whatever their names, are not read. Without any base span to
learn from the CRF adds nothing.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from hashlib import sha256
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The base patterns, kinds in the order that breaks ties.
ASSIGN = re.compile(r"""((?ai:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
HEX = re.compile(r"[0-9a-f]{32,}")
KINDS = ("assign", "access", "hex", "crf")
LIKELY = "(?i:password|passwd|secret|token|api_?key)[\"']? *[:=]|AKIA[A-Z0-9]{12}|[0-9a-f]{32}"
LEAST_VALUE = 8

SAMPLE_DOCS = 600  # documents with base spans, and as many without, that the CRF learns from
OTHERS = 3  # other stretches with digits, and as many without, taken from a document, about
WINDOW = 12  # tokens on either side of a secret in a training sequence
SEED, SHARES = 11, 1 << 20

TOKEN = re.compile(r"\w+(?:[+/.$!%^*~#-]+\w+)*|[^\w\s]")
DIGIT = re.compile(r"\d")
KEY_WORD = re.compile(r"(?ai:password|passwd|secret|token|api_?key)")
REACH = 3  # tokens back that a key word or assignment sign is seen from
KNOWN = 1 << 19  # tokens whose features a worker remembers

SIGNS = "=:_-/+\"'.,;!?"
OUT, BEGIN, INSIDE = range(3)
SHAPES, WORDS, CLUES, FILES = 64, 256, 8, 16
#: Rows of the weights where each feature group starts.
AT = np.cumsum([0, SHAPES, SHAPES, SHAPES, WORDS, WORDS, CLUES])
ROWS = int(AT[-1]) + FILES


def base_spans(text: str) -> list[tuple[int, int, str, tuple[int, int]]]:
    """(start, end, kind, value's span) of the fixed patterns, in order."""
    found = []
    if "=" in text or ":" in text:
        found += [(*m.span(), "assign", m.span(2)) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= LEAST_VALUE]
    if "AKIA" in text:
        found += [(*m.span(), "access", m.span()) for m in ACCESS.finditer(text)]
    found += [(*m.span(), "hex", m.span()) for m in HEX.finditer(text)]
    return sorted(found, key=lambda x: (x[0], KINDS.index(x[2])))


def shape(token: str) -> int:
    """A token's characters and length, 0 to 63: punctuation, then words, then from 32 on what has digits."""
    if not token[0].isalnum() and len(token) == 1:
        return 1 + SIGNS.find(token)
    lower, upper = token != token.upper(), token != token.lower()
    mixed = lower and upper and not token.istitle()
    size = (len(token) > 3) + (len(token) > 7) + (len(token) > 15)
    if DIGIT.search(token):
        return 32 + size * 8 + 4 * lower + 2 * upper + mixed
    return 16 + size * 4 + (3 if mixed else 2 * upper * lower + (upper and not lower))


def word(token: str) -> int:
    """A word feature: letters in lower case, digits as 0, hashed."""
    return crc32(DIGIT.sub("0", token.lower())[:12].encode("utf-8", "surrogatepass")) % WORDS


def file_feature(text: str) -> int:
    digits = len(DIGIT.findall(text))
    dense = min(3, int(np.log2(1 + 1000 * digits / max(1, len(text)))))
    return dense * 4 + (len(text) > 500) + (len(text) > 2000) + (len(text) > 20000)


class Known:
    """Shape, word, whether a key word is in it and whether it is an assignment sign, for the tokens seen lately."""

    def __init__(self):
        self.place: dict[str, int] = {}
        self.rows = np.zeros((KNOWN, 4), np.int32)

    def __call__(self, tokens: list[str]) -> np.ndarray:
        new = set(tokens).difference(self.place)
        if len(self.place) + len(new) > len(self.rows):
            new = set(tokens)
            self.place, self.rows = {}, np.zeros((max(KNOWN, len(new)), 4), np.int32)
        if new:
            at = len(self.place)
            self.rows[at : at + len(new)] = [(shape(t), word(t), KEY_WORD.search(t) is not None, t in ":=") for t in new]
            self.place.update(zip(new, range(at, at + len(new))))
        return self.rows[[self.place[t] for t in tokens]]


known = Known()


def columns(tokens: list[str]) -> list[np.ndarray]:
    """For each feature group but the file's, the row of the weights that is on at each token."""
    n = len(tokens)
    shapes, words, key, sign = np.pad(known(tokens).T, ((0, 0), (REACH, REACH)))
    beside = lambda x, k: x[REACH + k : REACH + k + n]
    near = lambda x: beside(x, -1) | beside(x, -2) | beside(x, -3)
    clue = 4 * near(key) + 2 * near(sign) + beside(key, 0)
    groups = (beside(shapes, 0), beside(shapes, -1), beside(shapes, 1), beside(words, -1), beside(words, 1), clue)
    return [start + group for start, group in zip(AT, groups)]


def features(tokens: list[str], file: int) -> np.ndarray:
    """Rows of the weights that are on at each token."""
    return np.stack([*columns(tokens), np.full(len(tokens), AT[6] + file)], 1)


def train(sequences: list[tuple[np.ndarray, np.ndarray]], rounds: int = 100, rate: float = 0.2, decay: float = 1e-3) -> tuple[np.ndarray, np.ndarray]:
    """Weights (ROWS, 3) and transitions (3, 3) of greatest penalised likelihood, by Adam on all sequences."""
    most = max(len(y) for _, y in sequences)
    feats = np.full((len(sequences), most, sequences[0][0].shape[1]), ROWS)
    tags = np.zeros((len(sequences), most), int)
    mask = np.zeros((len(sequences), most), bool)
    for k, (x, y) in enumerate(sequences):
        feats[k, : len(y)], tags[k, : len(y)], mask[k, : len(y)] = x, y, True
    weights, moves = np.zeros((ROWS + 1, 3)), np.zeros((3, 3))
    state = [np.zeros_like(p) for p in (weights, weights, moves, moves)]
    hot = np.eye(3)[tags] * mask[..., None]
    pairs = mask[:, 1:, None, None] * hot[:, :-1, :, None] * hot[:, 1:, None, :]
    lse = lambda x, axis: (m := x.max(axis, keepdims=True), np.squeeze(m, axis) + np.log(np.exp(x - m).sum(axis)))[1]
    for step in range(1, rounds + 1):
        score = weights[feats].sum(2)
        forward, backward = np.zeros_like(score), np.zeros_like(score)
        forward[:, 0] = score[:, 0]
        for t in range(1, most):
            on = lse(forward[:, t - 1, :, None] + moves, 1) + score[:, t]
            forward[:, t] = np.where(mask[:, t, None], on, forward[:, t - 1])
        for t in range(most - 2, -1, -1):
            back = lse(moves + (score[:, t + 1] + backward[:, t + 1])[:, None, :], 2)
            backward[:, t] = np.where(mask[:, t + 1, None], back, 0)
        total = lse(forward[:, -1], 1)[:, None, None]
        chance = np.exp(forward + backward - total) * mask[..., None]
        joint = forward[:, :-1, :, None] + moves + (score[:, 1:] + backward[:, 1:])[:, :, None, :] - total[..., None]
        joint = np.exp(np.where(mask[:, 1:, None, None], joint, -np.inf))
        rest = (chance - hot).reshape(-1, 3)
        slope = np.zeros_like(weights)
        for f in range(feats.shape[2]):
            for tag in range(3):
                slope[:, tag] += np.bincount(feats[..., f].ravel(), rest[:, tag], minlength=ROWS + 1)
        slopes = [slope / len(sequences) + decay * weights, (joint - pairs).sum((0, 1)) / len(sequences) + decay * moves]
        for p, g, m, v in ((weights, slopes[0], state[0], state[1]), (moves, slopes[1], state[2], state[3])):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            if p is weights:
                m[ROWS] = 0  # padding
            p -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return weights[:ROWS], moves


def viterbi(score: np.ndarray, moves: np.ndarray) -> np.ndarray:
    """The best tags of one sequence."""
    best, back = score[0], np.zeros(score.shape, np.int64)
    for t in range(1, len(score)):
        options = best[:, None] + moves
        back[t] = options.argmax(0)
        best = options.max(0) + score[t]
    tags = np.empty(len(score), np.int64)
    tags[-1] = best.argmax()
    for t in range(len(score) - 1, 0, -1):
        tags[t - 1] = back[t, tags[t]]
    return tags


class SecretTagger:
    """A trained CRF; ``cut``: whether the chain is cut at tokens proven to be outside."""

    def __init__(self, weights: np.ndarray, moves: np.ndarray):
        self.weights, self.moves, self.cut = weights, moves, True
        # The most that a tag in place of ``outside`` can win by the moves to it and from it.
        won = [(moves[:, tag] - moves[:, OUT]).max() + (moves[tag] - moves[OUT]).max() for tag in (BEGIN, INSIDE)]
        self.won = np.maximum(won, 0) + 1e-6

    def tags(self, tokens: list[str], file: int) -> np.ndarray:
        """The Viterbi tags of a whole text's tokens."""
        score = np.tile(self.weights[AT[6] + file], (len(tokens), 1))
        for group in columns(tokens):
            score += self.weights[group]
        if not self.cut:
            return viterbi(score, self.moves)
        tags = np.full(len(tokens), OUT)
        unsure = np.flatnonzero((score[:, :1] - score[:, 1:] <= self.won).any(1))
        for run in np.split(unsure, np.flatnonzero(np.diff(unsure) > 1) + 1) if len(unsure) else ():
            # With the tokens beside it, which are outside or the text's ends.
            low, high = max(0, run[0] - 1), run[-1] + 2
            tags[low:high] = viterbi(score[low:high], self.moves)
        return tags

    def spans(self, text: str) -> list[tuple[int, int]]:
        """The spans tagged as secrets."""
        tokens = TOKEN.findall(text)
        if not tokens:
            return []
        tags, found = self.tags(tokens, file_feature(text)), []
        if not tags.any():
            return found
        open_span = False
        for m, tag in zip(TOKEN.finditer(text), tags.tolist(), strict=True):
            if tag == INSIDE and open_span:
                found[-1] = (found[-1][0], m.end())
            elif tag != OUT:
                found.append(m.span())
            open_span = tag != OUT
        return found


def twin(value: str, k: int, symbols: bool) -> str:
    """Letters in place of a base value, of another length, in mixed or upper case; with ``symbols``, two of these within."""
    draw = np.random.default_rng([k, crc32(value.encode("utf-8", "surrogatepass")), symbols])
    mixed = draw.random() < 0.7  # upper-case words of prose are short
    small = draw.random(32) < 0.5 * mixed
    letters = [chr(c + (97 if low else 65)) for c, low in zip(draw.integers(0, 26, draw.integers(10 if mixed else 18, 32)), small)]
    if symbols:
        for at in draw.integers(2, len(letters) - 2, 2):
            letters[at] = "$!%^*~#"[draw.integers(0, 7)]
        if draw.random() < 0.5:
            letters[-2] = str(draw.integers(0, 10))
    return "".join(letters)


def sequences(texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Training sequences: the tokens around each base value and its twins, and around some other tokens."""
    out = []
    for text in texts:
        values = sorted({value for *_, value in base_spans(text)})
        file = file_feature(text)
        places = [m.span() for m in TOKEN.finditer(text)]
        starts = np.array([a for a, _ in places], np.int64)
        if not places:
            continue
        tokens = [text[x:y] for x, y in places]
        tags_of = np.zeros(len(places), np.int64)
        for u, v in values:
            for k in range(max(0, int(np.searchsorted(starts, u, side="right")) - 1), len(places)):
                if places[k][0] >= v:
                    break
                if places[k][1] > u:
                    tags_of[k] = BEGIN if k == 0 or places[k - 1][1] <= u else INSIDE
        # Around each value, and around other tokens with and without digits, evenly taken from the text.
        free = np.flatnonzero(tags_of == OUT)
        digits = [k for k in free if DIGIT.search(tokens[k])]
        plain = [k for k in free if tokens[k][0].isalnum() and not DIGIT.search(tokens[k])]
        others = [places[k] for side in (digits, plain) for k in side[:: 1 + len(side) // OTHERS]]
        for a, b in [*values, *others]:
            low = max(0, int(np.searchsorted(starts, a)) - WINDOW)
            high = min(len(places), int(np.searchsorted(starts, b)) + WINDOW, low + 4 * WINDOW)
            # Features see the neighbours outside the window too.
            around = slice(max(0, low - REACH), min(len(places), high + REACH))
            rows = features(tokens[around], file)
            out.append((rows[low - around.start :][: high - low], tags_of[low:high]))
        # Twins of the values, and in a text without values some in its middle, so that a file's digits don't decide.
        spots = [(int(np.searchsorted(starts, a)), int(np.searchsorted(starts, b)), a, b) for a, b in values]
        spots = spots or [(len(places) // 2,) * 2 + (0, 0)]
        for at, after, a, b in spots:
            low = max(0, at - WINDOW)
            if tags_of[low:at].any() or tags_of[after : after + WINDOW].any():
                continue  # only what is known to be no secret stands around a twin
            before, behind = tokens[low:at], tokens[after : after + WINDOW]
            bare = [t for t in before if t not in "=:\"'" and not KEY_WORD.search(t)]
            for n, side in enumerate((before, bare) if values else (bare,)):
                for symbols in (False, True):
                    own = TOKEN.findall(twin(text[a:b] or text[:64], n, symbols))
                    tags = [OUT] * len(side) + [BEGIN] + [INSIDE] * (len(own) - 1) + [OUT] * len(behind)
                    out.append((features([*side, *own, *behind], file), np.array(tags)))
    return out


def likely_of(text_col: str):
    """Whether a text may have base spans; decided in the JVM."""
    return F.coalesce(F.col(text_col).rlike(LIKELY), F.lit(False))


def learn(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> SecretTagger | None:
    """Train on a bounded sample: SAMPLE_DOCS documents with base spans and as many without, lowest hash of id first."""
    text = F.col(text_col)
    share = F.pmod(F.xxhash64(F.col(id_col), text, F.lit(SEED)), F.lit(SHARES))
    rows = docs.where(text.isNotNull()).select(text.alias("text"), share.alias("share"))
    sizes = {r["likely"]: r["n"] for r in rows.groupBy(likely_of("text").alias("likely")).agg(F.count("*").alias("n")).collect()}
    sample: list[str] = []
    for side, n in sorted(sizes.items(), reverse=True):
        # Only about three times as many rows as are wanted are sorted, however many tasks there are.
        few = rows.where(F.col("share") < -(-3 * SAMPLE_DOCS * SHARES // n)).where(likely_of("text") == side)
        chosen = few.orderBy("share", F.xxhash64("text"), "text").limit(SAMPLE_DOCS)
        sample += [r["text"] for r in chosen.collect()]
    found = sequences(sample)
    if not any(y.any() for _, y in found):
        return None
    return SecretTagger(*train(found))


NAMES = ("n_assign", "n_access", "n_hex", "n_crf", "base_sha256", "spans")


def scan(docs: DataFrame, tagger: SecretTagger | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, counts by kind, ``found`` (kind, start, end), base_sha256 and spans as text."""
    shared = docs.sparkSession.sparkContext.broadcast(tagger)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        crf = shared.value
        for batch in batches:
            out = []
            for text in (t.as_py() or "" for t in batch.column(1)):
                base = base_spans(text)
                added = [(a, b, "crf") for a, b in crf.spans(text) if all(b <= x or a >= y for x, y, *_ in base)] if crf else []
                every = sorted([*(s[:3] for s in base), *added], key=lambda x: (x[0], KINDS.index(x[2])))
                said = ",".join(f"{kind}:{a}:{b}" for a, b, kind, _ in base)
                counts = [sum(s[2] == kind for s in every) for kind in KINDS]
                out.append((*counts, sha256(said.encode()).hexdigest(), ",".join(f"{kind}:{a}:{b}" for a, b, kind in every)))
            columns = list(zip(*out, strict=True)) or [()] * 6
            arrays = [pa.array(c, pa.int64() if k < 4 else pa.string()) for k, c in enumerate(columns)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], names=["id", *NAMES])

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    schema = f"id {kind}, " + ", ".join(f"{name} {'long' if k < 4 else 'string'}" for k, name in enumerate(NAMES))
    return rows.mapInArrow(run, schema).withColumnRenamed("id", id_col)


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Learn from the documents' sample and scan them all."""
    return scan(docs, learn(docs, id_col, text_col), id_col, text_col)
