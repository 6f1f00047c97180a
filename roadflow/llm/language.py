"""Language of words and texts by a linear-chain conditional random field."""

from __future__ import annotations

import functools
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import of_texts
from .textvec import NOT_LETTERS, U, Block, blocks

DIM_BITS = 18
#: About so many documents a language are used to fit, and of each so many runs of so many words.
MOST_DOCS, RUNS, RUN_WORDS = 800, 6, 24
STEPS, RATE, DECAY = 40, 0.15, 1e-6
#: One chain in so many is held back from the fit; it ends when their words' mean loss has fallen by less than a share of
#: LEAST_GAIN in PATIENCE steps.
HELD, LEAST_GAIN, PATIENCE = 10, 0.05, 2
PREFIXES, SUFFIXES = (1, 2, 3), (1, 2, 3, 4)
UNKNOWN = "und"
#: Scripts that are written without spaces, as ranges of code points: each of their characters is a word.
ALONE = (
    (0x0E00, 0x0EFF), (0x0F00, 0x0FFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x3005, 0x3007), (0x3040, 0x30FF), (0x31F0, 0x31FF), (0x3400, 0x9FFF),
    (0xF900, 0xFAFF), (0xFF66, 0xFF9F), (0x20000, 0x3FFFF),
)


@functools.lru_cache(maxsize=1)
def _kinds() -> np.ndarray:
    """Kind of each code point: 1 for punctuation, symbols and spaces beyond ASCII, 2 for characters that are words."""
    table = np.zeros(0x40001, np.uint8)
    for c in range(0x80, 0x20000):
        if unicodedata.category(chr(c))[0] in "PSZ":
            table[c] = 1
    for low, high in ALONE:
        part = table[low : high + 1]
        part[part == 0] = 2
    return table


def spaced(text: str | None) -> str:
    """The text in lower case, with a space for marks beyond ASCII and around each character of a script without spaces."""
    low = (text or "").lower()
    if low.isascii():
        return low
    points = np.frombuffer(low.encode("utf-32-le", "surrogatepass"), np.uint32)
    kind = _kinds()[np.minimum(points, 0x40000)]
    if not kind.any():
        return low
    size = np.where(kind == 2, 3, 1)
    out = np.repeat(np.where(kind == 1, np.uint32(32), points), size)
    begin = (np.cumsum(size) - size)[kind == 2]
    out[begin], out[begin + 2] = 32, 32
    return out.astype("<u4").tobytes().decode("utf-32-le", "surrogatepass")


def word_features(block: Block, s: np.ndarray, e: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word and bucket of each feature: the word itself (lexicon), its affixes, its trigrams; in the order of words."""
    shift, size, salt = U(64 - DIM_BITS), e - s, 0
    words, buckets = [], []

    def add(at: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
        nonlocal salt
        salt += 1
        words.append(at)
        buckets.append((block.hashes(a, b) ^ U(salt * 0x9E3779B97F4A7C15 & (1 << 64) - 1)) >> shift)

    every = np.arange(len(s))
    add(every, s, e)
    for n in PREFIXES:
        at = every[size >= n]
        add(at, s[at], s[at] + n)
    for n in SUFFIXES:
        at = every[size >= n]
        add(at, e[at] - n, e[at])
    grams = np.maximum(size - 2, 0)
    at = np.repeat(every, grams)
    p = s[at] + np.arange(len(at)) - np.repeat(np.cumsum(grams) - grams, grams)
    salt = 99  # a trigram counts alike wherever it stands
    add(at, p, p + 3)
    return np.concatenate(words), np.concatenate(buckets).astype(np.int64)


def emissions(weights: np.ndarray, word: np.ndarray, bucket: np.ndarray, n: int) -> np.ndarray:
    return np.stack([np.bincount(word, weights[bucket, k], n) for k in range(weights.shape[1])], axis=1)


@dataclass
class Model:
    langs: list[str]
    weights: np.ndarray  # bucket x language
    moves: np.ndarray  # language x language
    start: np.ndarray

    def marginals(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Row of each word, and the probability of each language there."""
        block = Block([spaced(t) for t in texts])
        s, e, row = block.words(NOT_LETTERS)
        if not len(s):
            return row, np.zeros((0, len(self.langs)))
        _, first, at = np.unique(block.hashes(s, e), return_index=True, return_inverse=True)
        em = emissions(self.weights, *word_features(block, s[first], e[first]), len(first))
        em = np.exp(em - em.max(axis=1, keepdims=True)) + 1e-12
        return row, forward_backward(em[at], np.concatenate(([True], row[1:] != row[:-1])), self.moves, self.start)


def forward_backward(em: np.ndarray, first: np.ndarray, moves: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Marginals of many chains that stand one after the other; ``first`` marks where each begins.

    The whole is cut into about sqrt(n) pieces of equal length that are walked side by side: once for each piece's
    transfer matrix, then, from the vectors at the cuts, forward and backward. Chain length doesn't matter.
    """
    n, k = em.shape
    length = max(1, int(np.sqrt(n)))
    pieces = -(-n // length)
    pad = pieces * length - n
    em = np.concatenate((em, np.ones((pad, k)))).reshape(pieces, length, k)
    first = np.concatenate((first, np.ones(pad, bool))).reshape(pieces, length)
    move, begin = np.exp(moves - moves.max()), np.exp(start - start.max())
    transfer = np.broadcast_to(np.eye(k), (pieces, k, k)).copy()
    for t in range(length):
        stepped = transfer @ move
        fresh = first[:, t]
        if fresh.any():
            stepped[fresh] = transfer[fresh].sum(axis=2, keepdims=True) * begin
        stepped *= em[:, t, None, :]
        transfer = stepped / stepped.max(axis=(1, 2), keepdims=True)
    ahead, behind = np.empty((pieces, k)), np.empty((pieces, k))
    v = np.full(k, 1 / k)
    for c in range(pieces):
        ahead[c] = v
        v = v @ transfer[c]
        v /= v.sum()
    v = np.full(k, 1.0)
    for c in range(pieces - 1, -1, -1):
        behind[c] = v
        v = transfer[c] @ v
        v /= v.max()
    out = np.empty_like(em)
    v = ahead
    for t in range(length):
        v = np.where(first[:, t, None], begin, v @ move) * em[:, t]
        v /= v.sum(axis=1, keepdims=True)
        out[:, t] = v
    v = behind
    for t in range(length - 1, -1, -1):
        out[:, t] *= v
        v = np.where(first[:, t, None], 1.0, (em[:, t] * v) @ move.T)
        v /= v.max(axis=1, keepdims=True)
    out = out.reshape(-1, k)[:n]
    return out / out.sum(axis=1, keepdims=True)


def fit(runs: list[str], langs: list[str], group: list[int]) -> Model:
    """From runs of words with their languages. Half of the training chains join runs of different documents, so that
    the transitions see switches; gradients are expected minus seen counts, by forward-backward. Every tenth chain only
    tells when to stop."""
    names = sorted(set(langs))
    k = len(names)
    rng = np.random.default_rng(11)
    if not names:
        return Model([], np.zeros((1 << DIM_BITS, 0)), np.zeros((0, 0)), np.zeros(0))
    order = np.argsort(np.asarray(group), kind="stable")
    half = len(order) // 2
    order = np.concatenate((order[:half], rng.permutation(order[half:])))
    chains = [order[i : i + 2] for i in range(0, len(order), 2)]
    texts = [" ".join(runs[i] for i in c) for c in chains]
    block = Block(texts)
    s, e, row = block.words(NOT_LETTERS)
    label = np.concatenate([np.repeat([names.index(langs[i]) for i in c], [len(Block([runs[i]]).words(NOT_LETTERS)[0]) for i in c]) for c in chains]) if chains else np.zeros(0, int)
    first = np.concatenate(([True], row[1:] != row[:-1]))[: len(row)]
    _, one, at = np.unique(block.hashes(s, e), return_index=True, return_inverse=True)
    word, bucket = word_features(block, s[one], e[one])
    used, bucket = np.unique(bucket, return_inverse=True)
    truth = np.eye(k)[label]
    held = (row % HELD == HELD - 1) if len(chains) >= 2 * HELD else np.zeros(len(row), bool)
    inner = ~first & ~held
    seen = np.zeros((k, k))
    np.add.at(seen, (label[:-1][inner[1:]], label[1:][inner[1:]]), 1)
    losses: list[float] = []
    params = {"w": np.zeros((len(used), k)), "a": np.zeros((k, k)), "s": np.zeros(k)}
    m1 = {n: np.zeros_like(p) for n, p in params.items()}
    m2 = {n: np.zeros_like(p) for n, p in params.items()}
    for t in range(1, STEPS + 1):
        raw = emissions(params["w"], word, bucket, len(one))
        em = (np.exp(raw - raw.max(axis=1, keepdims=True)) + 1e-12)[at]
        post = forward_backward(em, first, params["a"], params["s"])
        if held.any():
            losses.append(float(-np.log(post[held, label[held]] + 1e-12).mean()))
            if len(losses) > PATIENCE and losses[-1] > (1 - LEAST_GAIN) * losses[-1 - PATIENCE]:
                break
        error = np.where(held[:, None], 0.0, post - truth)
        by_word = np.stack([np.bincount(at, error[:, j], len(one)) for j in range(k)], axis=1)
        pair = pair_counts(em[~held], first[~held], params["a"], params["s"])
        grad = {
            "w": np.stack([np.bincount(bucket, by_word[word, j], len(used)) for j in range(k)], axis=1) / len(s) + DECAY * params["w"],
            "a": (pair - seen) / len(s),
            "s": error[first].sum(axis=0) / len(s),
        }
        for n, g in grad.items():
            m1[n] = 0.9 * m1[n] + 0.1 * g
            m2[n] = 0.99 * m2[n] + 0.01 * g * g
            params[n] = params[n] - RATE * (m1[n] / (1 - 0.9**t)) / (np.sqrt(m2[n] / (1 - 0.99**t)) + 1e-9)
    weights = np.zeros((1 << DIM_BITS, k), np.float32)
    weights[used] = params["w"]
    return Model(names, weights, params["a"], params["s"])


def pair_counts(em: np.ndarray, first: np.ndarray, moves: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Expected number of each transition."""
    k = em.shape[1]
    out = np.zeros((k, k))
    begins = np.flatnonzero(first)
    sizes = np.diff(np.concatenate((begins, [len(em)])))
    longest = int(sizes.max()) if len(sizes) else 0
    move, begin = np.exp(moves - moves.max()), np.exp(start - start.max())
    padded = np.ones((len(begins), longest, k))
    inside = np.arange(longest) < sizes[:, None]
    padded[inside] = em
    ahead = np.empty_like(padded)
    v = begin * padded[:, 0]
    for t in range(longest):
        if t:
            v = (v @ move) * padded[:, t]
        v = v / v.sum(axis=1, keepdims=True)
        ahead[:, t] = v
    b = np.ones((len(begins), k))
    for t in range(longest - 1, 0, -1):
        live = inside[:, t]
        joint = ahead[:, t - 1, :, None] * move * (padded[:, t] * b)[:, None, :]
        joint /= joint.sum(axis=(1, 2), keepdims=True)
        out += joint[live].sum(axis=0)
        b = np.where(live[:, None], (padded[:, t] * b) @ move.T, 1.0)
        b /= b.max(axis=1, keepdims=True)
    return out


def _runs(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in frames:
        out = []
        for doc, text, lang in zip(pdf["doc_id"], pdf["text"], pdf["lang"], strict=True):
            words = spaced(text).split()
            n = len(words)
            for i in sorted({int(i) for i in np.linspace(0, max(n - RUN_WORDS, 0), RUNS)}) if n else ():
                out.append((doc, lang, i, " ".join(words[i : i + RUN_WORDS])))
        yield pd.DataFrame(out, columns=["doc_id", "lang", "at", "run"])


def train(docs: DataFrame, most_docs: int = MOST_DOCS) -> Model:
    """A model from ``docs(doc_id, text, lang)``; rows without lang or text are left out.

    The fit reads about ``most_docs`` documents a language, drawn by a hash of the id, and of each at most ``RUNS``
    runs of ``RUN_WORDS`` words spread over its text; only those runs come to the driver.
    """
    known = docs.where("lang IS NOT NULL AND text IS NOT NULL")
    counts = {r["lang"]: r["count"] for r in known.groupBy("lang").count().collect()}  # a row for each language
    if not counts:
        return fit([], [], [])
    part = F.create_map(*[F.lit(v) for c, n in counts.items() for v in (c, min(1.0, most_docs / n))])
    u = F.pmod(F.xxhash64("doc_id", F.lit("fit")), F.lit(1 << 20)) / float(1 << 20)
    sample = known.where(u < F.element_at(part, F.col("lang")))
    runs = sample.select("doc_id", "text", "lang").mapInPandas(_runs, "doc_id long, lang string, at int, run string").toPandas()
    runs = runs.sort_values(["doc_id", "at"])
    return fit(runs["run"].tolist(), runs["lang"].tolist(), runs["doc_id"].tolist())


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, lang_pred, score, n_words, n_switches`` of every whole text, in one pass without a shuffle.

    A text's language is the one with the largest mean probability over its words, and that mean is the score;
    ``n_switches`` counts the places where the likeliest language of neighbouring words changes. Texts that are null
    or have no letter are ``und`` with score 0. The broadcast model has a fixed size for a given set of languages.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def begin():
        m = shared.value

        def found(texts: list[str | None]) -> pd.DataFrame:
            n = len(texts)
            row, post = m.marginals(texts) if m.langs and n else (np.zeros(0, int), np.zeros((0, max(len(m.langs), 1))))
            words = np.bincount(row, minlength=n)
            mean = np.stack([np.bincount(row, post[:, k], n) for k in range(post.shape[1])], axis=1) / np.maximum(words, 1)[:, None]
            best = post.argmax(axis=1)
            change = np.flatnonzero((best[1:] != best[:-1]) & (row[1:] == row[:-1]))
            letters = np.array([any(map(str.isalpha, t)) if t else False for t in texts], bool)
            ok = letters & (words > 0) & bool(m.langs)
            names = np.array([*m.langs, UNKNOWN], object)
            return pd.DataFrame({
                "lang_pred": names[np.where(ok, mean.argmax(axis=1), len(m.langs))],
                "score": np.where(ok, np.clip(mean.max(axis=1), 0, 1), 0.0),
                "n_words": words.astype(np.int64),
                "n_switches": np.bincount(row[change], minlength=n).astype(np.int64),
            })

        return found

    picked = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    scored = of_texts(picked, "text", "found", "struct<lang_pred:string,score:double,n_words:bigint,n_switches:bigint>", begin)
    return scored.select("doc_id", "found.*")


def fit_rows(ident) -> "F.Column":
    """Rows that may be learnt from: crc32 of the id as text, modulo 5, is not 0."""
    return F.pmod(F.crc32(ident.cast("string").cast("binary")), F.lit(5)) != 0
