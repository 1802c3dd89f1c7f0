"""Language ID: a linear-chain conditional random field labels the words of code-switched text by forward-backward.

A word's evidence comes from its affixes and n-grams (hashed) and from lexicons of the languages' frequent words; the
transitions between the labels of neighbouring words are learned with it. A text's language is that with most of the
words' posterior mass.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

UNKNOWN = "und"
#: Bounds of the training sample: documents for each language, words for each sequence, sequences, and these for each language if that is more.
SAMPLE_DOCS, SEQUENCE_WORDS, SEQUENCES, SEQUENCES_EACH = 150, 48, 3000, 100
#: Weights of hashed features; words for each language's lexicon; words that a worker remembers; words that it labels at a time.
FEATURES, LEXICON, REMEMBERED, BLOCK = 1 << 16, 400, 150_000, 80_000
#: Bits by which the n-grams of the training words are remembered, to tell text that is in no learned language.
GRAM_BITS = 22
#: Characters that are not part of words (ASCII punctuation and digits).
NOT_IN_WORDS = bytes(b for b in range(33, 127) if not chr(b).isalpha())
EDGE_LEFT, EDGE_RIGHT = b"\x02", b"\x03"


def plain_words(line: str) -> list[bytes]:
    return line.lower().encode("utf-8", "surrogatepass").translate(None, NOT_IN_WORDS).split()


def grams(words: list[bytes], bits: int = FEATURES.bit_length() - 1) -> tuple[np.ndarray, np.ndarray]:
    """Hashed features of words: numbers of features (of so many bits), and for each the number of its word.

    The n-grams of 2 to 4 bytes of the word between two edge marks; those with a mark are its affixes.
    """
    flat = np.frombuffer(b"".join([EDGE_LEFT + w + EDGE_RIGHT for w in words]), np.uint8).astype(np.uint64)
    lengths = np.fromiter((len(w) + 2 for w in words), np.int64, len(words))
    owner = np.repeat(np.arange(len(words)), lengths)
    features, owners = [], []
    rolling = flat.copy()
    for n in (2, 3, 4):
        if len(flat) < n:
            break
        rolling = rolling[:-1] * np.uint64(0x100000001B3) ^ flat[n - 1 :]
        whole = owner[n - 1 :] == owner[: len(owner) - n + 1]
        mixed = rolling[whole] * np.uint64(0x9E3779B97F4A7C15)
        features.append((mixed >> np.uint64(64 - bits)).astype(np.int64))
        owners.append(owner[n - 1 :][whole])
    return np.concatenate(features), np.concatenate(owners)


def gram_set(words: list[bytes]) -> np.ndarray:
    """The n-grams of words, as a bit for each hash."""
    bits = np.zeros(1 << GRAM_BITS, bool)
    if words:
        bits[grams(words, GRAM_BITS)[0]] = True
    return np.packbits(bits)


def known_share(words: list[bytes], own: np.ndarray) -> np.ndarray:
    """The share of each word's n-grams that are in a set."""
    if not words:
        return np.zeros(0)
    found, owner = grams(words, GRAM_BITS)
    hits = (own[found >> 3] >> (7 - (found & 7)).astype(np.uint8)) & 1
    return np.bincount(owner, hits, len(words)) / np.bincount(owner, minlength=len(words))


def forward_backward(scores: np.ndarray, transitions: np.ndarray, start: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """Posterior of each word's label, expected transitions summed over all, and the log of the partition functions' product.

    ``scores`` holds the words of all chains one after the other; chains are handled together, step by step, longest first.
    """
    n_labels = scores.shape[1]
    order = np.argsort(-lengths, kind="stable")
    begin = (np.cumsum(lengths) - lengths)[order]
    sizes = lengths[order]
    top = scores.max(1, keepdims=True) if len(scores) else scores
    local, moves = np.exp(scores - top), np.exp(transitions)
    forward, scale = np.empty_like(local), np.ones(len(local))
    longest = int(sizes[0]) if len(sizes) else 0
    active = np.searchsorted(-sizes, -np.arange(longest), side="left")  # chains with more words than t
    for t in range(longest):
        at = begin[: active[t]] + t
        now = local[at] * (np.exp(start) if t == 0 else forward[at - 1] @ moves)
        scale[at] = now.sum(1)
        forward[at] = now / scale[at][:, None]
    backward = np.ones_like(local)
    expected = np.zeros((n_labels, n_labels))
    for t in range(longest - 1, 0, -1):
        at = begin[: active[t]] + t
        came = local[at] * backward[at] / scale[at][:, None]
        backward[at - 1] = came @ moves.T
        expected += moves * (forward[at - 1].T @ came)
    return forward * backward, expected, float(np.log(scale).sum() + top.sum())


@dataclass
class Model:
    """Weights of a trained field. A few MB, whatever the size of the corpus."""

    labels: list[str]
    weights: np.ndarray
    lexicon: dict[bytes, np.ndarray]
    lexicon_weight: np.ndarray
    transitions: np.ndarray
    start: np.ndarray
    #: The n-grams of all training words, and the share of them that the words of a text in a learned language hold at least.
    grams: np.ndarray
    least_known: float

    def scores(self, words: list[bytes]) -> np.ndarray:
        if not words:
            return np.zeros((0, len(self.labels)))
        features, owner = grams(words)
        out = np.empty((len(words), len(self.labels)))
        for k in range(len(self.labels)):
            out[:, k] = np.bincount(owner, self.weights[features, k], len(words))
        out /= np.sqrt(np.bincount(owner, minlength=len(words)))[:, None]
        none = np.zeros(len(self.labels))
        return out + np.array([self.lexicon.get(w, none) for w in words]) * self.lexicon_weight


def train(texts: list[str], langs: list[str], seed: int = 7, rounds: int = 4, rate: float = 0.1) -> Model:
    """Fit a field on labelled documents, by Adam on the conditional log-likelihood.

    Sequences are stretches of one or more documents of different languages set one after the other, so that the
    transitions are learned from switches; a word has its document's language.
    """
    labels = sorted(set(langs))
    number = {lang: k for k, lang in enumerate(labels)}
    rng = np.random.default_rng(seed)
    words = [plain_words(t) for t in texts]
    counts = [Counter() for _ in labels]
    for own, lang in zip(words, langs):
        counts[number[lang]].update(own)
    lexicon: dict[bytes, np.ndarray] = {}
    for k, count in enumerate(counts):
        for word, _ in sorted(count.items(), key=lambda x: (-x[1], x[0]))[:LEXICON]:
            lexicon.setdefault(word, np.zeros(len(labels)))[k] = 1.0
    stretches: list[list[int]] = [[i for i, own in enumerate(words) if own and number[langs[i]] == k] for k in range(len(labels))]
    usable = [k for k in range(len(labels)) if stretches[k]]
    chains, truth = [], []
    for _ in range(max(SEQUENCES, SEQUENCES_EACH * len(usable)) if usable else 0):
        chain, labels_of = [], []
        while len(chain) < SEQUENCE_WORDS:
            k = int(rng.choice(usable))
            own = words[int(rng.choice(stretches[k]))]
            size = int(rng.integers(1, SEQUENCE_WORDS))
            begin = int(rng.integers(0, len(own)))
            part = own[begin : begin + size]
            chain += part
            labels_of += [k] * len(part)
        chains.append(chain)
        truth.append(labels_of)
    known = {w: i for i, w in enumerate(dict.fromkeys(w for c in chains for w in c))}
    n = len(labels)
    model = Model(labels, np.zeros((FEATURES, n)), lexicon, np.ones(n), np.zeros((n, n)), np.zeros(n), *familiar(words, langs))
    if not known:
        return model
    features, owner = grams(list(known))
    share = 1 / np.sqrt(np.bincount(owner, minlength=len(known)))
    by_word = np.argsort(owner, kind="stable")
    first, features = np.searchsorted(owner[by_word], np.arange(len(known) + 1)), features[by_word]
    hits = np.array([lexicon.get(w, np.zeros(n)) for w in known])
    params = [model.weights, model.lexicon_weight, model.transitions, model.start]
    means, squares, step = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0
    for _ in range(rounds):
        for batch in np.array_split(rng.permutation(len(chains)), max(1, len(chains) // 100)):
            ids = np.array([known[w] for i in batch for w in chains[i]])
            gold = np.array([k for i in batch for k in truth[i]])
            lengths = np.array([len(chains[i]) for i in batch])
            used, back = np.unique(ids, return_inverse=True)
            spans = first[used + 1] - first[used]
            rows = np.repeat(np.arange(len(used)), spans)
            at = features[np.repeat(first[used], spans) + np.arange(spans.sum()) - np.repeat(np.cumsum(spans) - spans, spans)]
            emit = np.stack([np.bincount(rows, model.weights[at, k], len(used)) for k in range(n)], 1) * share[used][:, None]
            scores = (emit + hits[used] * model.lexicon_weight)[back]
            posterior, moved, _ = forward_backward(scores, model.transitions, model.start, lengths)
            miss = -posterior
            miss[np.arange(len(gold)), gold] += 1
            starts = np.cumsum(lengths) - lengths
            inner = np.ones(len(gold), bool)
            inner[starts] = False
            seen = np.zeros((n, n))
            np.add.at(seen, (gold[np.flatnonzero(inner) - 1], gold[inner]), 1)
            per_word = np.stack([np.bincount(back, miss[:, k], len(used)) for k in range(n)], 1)
            slope = np.stack([np.bincount(at, (per_word[:, k] * share[used])[rows], FEATURES) for k in range(n)], 1)
            slopes = [slope, (miss * hits[used][back]).sum(0), seen - moved, miss[starts].sum(0)]
            step += 1
            for p, g, m, s in zip(params, slopes, means, squares):
                g = g / len(batch) - 1e-5 * p
                m += 0.1 * (g - m)
                s += 0.001 * (g * g - s)
                p += rate * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.999**step)) + 1e-8)
    return model


def familiar(words: list[list[bytes]], langs: list[str]) -> tuple[np.ndarray, float]:
    """The n-grams of the documents' words, and half of what one half of them knows of the other, for the language where that is least.

    It is asked whether the n-grams are known and not how sure a label is, so that a word which several languages share
    counts in full. Where a language has little text the bound falls, as little can be told from it.
    """
    halves: list[dict[str, list[list[bytes]]]] = [{}, {}]
    for lang in set(langs):
        own = [w for w, of in zip(words, langs) if of == lang and w]
        own = own if len(own) > 1 else [[x] for w in own for x in w]
        halves[0][lang], halves[1][lang] = own[::2], own[1::2]
    flat = lambda docs: [w for d in docs for w in d]
    first = gram_set(list(dict.fromkeys(w for docs in halves[0].values() for w in flat(docs))))
    shares = [known_share(flat(docs), first) if any(docs) else np.zeros(1) for docs in halves[1].values()]
    return gram_set(list(dict.fromkeys(flat(words)))), 0.5 * min((float(x.mean()) for x in shares), default=0.0)


class Labeller:
    """Labels texts in a worker. Remembers the evidence of a bounded number of words."""

    def __init__(self, model: Model):
        self.model, self.seen, self.table, self.known = model, {}, np.zeros((0, len(model.labels))), np.zeros(0)

    def lookup(self, words: list[bytes]) -> np.ndarray:
        if len(self.seen) > REMEMBERED:
            self.seen, self.table, self.known = {}, self.table[:0], self.known[:0]
        fresh = list(set(words).difference(self.seen))
        if fresh:
            self.seen.update(zip(fresh, range(len(self.seen), len(self.seen) + len(fresh))))
            self.table = np.concatenate([self.table, self.model.scores(fresh)])
            self.known = np.concatenate([self.known, known_share(fresh, self.model.grams)])
        return np.fromiter(map(self.seen.__getitem__, words), np.int64, len(words))

    def blocks(self, texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Posteriors of all words, and the number of the text of each, some lines at a time. Each line is a chain."""
        return ((found, owner) for found, owner, _ in self.judged(texts))

    def judged(self, texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """As ``blocks``, and the known share of each word's n-grams.

        A block ends with the line that brings it to BLOCK words, so memory follows the longest line and not the longest text.
        """
        words, lengths, owner = [], [], []
        for i, text in enumerate(texts):
            for line in (text or "").split("\n"):
                own = plain_words(line)
                if own:
                    words += own
                    lengths.append(len(own))
                    owner.append(i)
                if len(words) >= BLOCK:
                    yield self.posteriors(words, lengths, owner)
                    words, lengths, owner = [], [], []
        if words:
            yield self.posteriors(words, lengths, owner)

    def posteriors(self, words: list[bytes], lengths: list[int], owner: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        ids, sizes = self.lookup(words), np.array(lengths, np.int64)
        found, _, _ = forward_backward(self.table[ids], self.model.transitions, self.model.start, sizes)
        return found, np.repeat(np.array(owner, np.int64), sizes), self.known[ids]

    def label(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """Language and score of each text."""
        return self.judge(texts)[:2]

    def judge(self, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language and score of each text, and whether it is in learned languages, however many it is mixed from."""
        if not self.model.labels:
            return [UNKNOWN] * len(texts), np.zeros(len(texts)), np.zeros(len(texts), bool)
        mass, familiar = np.zeros((len(texts), len(self.model.labels))), np.zeros(len(texts))
        for found, owner, share in self.judged(texts):
            first = int(owner[0])
            size = int(owner[-1]) + 1 - first
            for k in range(mass.shape[1]):
                mass[first : first + size, k] += np.bincount(owner - first, found[:, k], size)
            familiar[first : first + size] += np.bincount(owner - first, share, size)
        total = mass.sum(1)
        best = mass.argmax(1)
        score = np.clip(mass[np.arange(len(texts)), best] / np.maximum(total, 1e-300), 0, 1)
        known = np.array([n > 0 and has_letter(t) for n, t in zip(total, texts)], bool)
        learned = known & (familiar >= self.model.least_known * total * (1 - 1e-9))
        return [self.model.labels[b] if k else UNKNOWN for b, k in zip(best, known)], np.where(known, score, 0.0), learned

    def spans(self, text: str | None) -> list[tuple[int, int, str]]:
        """Runs of words with one language: first word, end, language."""
        out: list[tuple[int, int, str]] = []
        for i, k in enumerate(k for found, _ in self.blocks([text]) for k in found.argmax(1).tolist()):
            lang = self.model.labels[k]
            out = [*out[:-1], (out[-1][0], i + 1, lang)] if out and out[-1][2] == lang else [*out, (i, i + 1, lang)]
        return out


def has_letter(text: str | None) -> bool:
    return any(map(str.isalpha, text or ""))


def training_sample(docs: DataFrame, lang: str = "lang", text: str = "text", doc_id: str = "doc_id", per_lang: int = SAMPLE_DOCS) -> tuple[list[str], list[str]]:
    """Whole texts and languages of ``per_lang`` documents of every language, or of all that a language has.

    The documents are those with the smallest hashes of id and text, so the sample is the same on each run and does not
    depend on ids: rows without one, or with the same, are told apart by their texts. Rows alike in both are one.
    Ranks are limited before the shuffle, so a language that has most documents is no burden.
    """
    labelled = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull())
    rank = F.xxhash64(F.lit("sample"), F.col(doc_id), F.col(text)).alias("rank")
    labelled = labelled.select(F.col(lang).cast("string").alias("lang"), F.col(text).alias("text"), rank)
    # Equal ranks share a place, so that many copies of a text do not take the places of others.
    place = F.dense_rank().over(Window.partitionBy("lang").orderBy("rank"))
    chosen = labelled.select("lang", "rank").withColumn("place", place).where(F.col("place") <= per_lang)
    # At most per_lang rows of two short columns for each language.
    chosen = chosen.select(F.col("lang").alias("l"), F.col("rank").alias("r")).distinct()
    rows = labelled.join(F.broadcast(chosen), (F.col("lang") == F.col("l")) & (F.col("rank") == F.col("r"))).dropDuplicates(["lang", "rank"])
    rows = rows.orderBy("lang", "rank").select("lang", "text").collect()
    return [r["text"] for r in rows], [r["lang"] for r in rows]


def predict(model: Model):
    """A function of a text column: a struct of ``lang_pred``, ``score`` and ``learned`` (the text is in learned languages)."""
    @F.pandas_udf("lang_pred string, score double, learned boolean")
    def labelled(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        own = Labeller(model)
        for texts in batches:
            langs, scores, learned = own.judge([t if isinstance(t, str) else None for t in texts])
            yield pd.DataFrame({"lang_pred": langs, "score": scores, "learned": learned})

    return labelled


def learn(train_docs: DataFrame, lang: str = "lang", text: str = "text", doc_id: str = "doc_id", per_lang: int = SAMPLE_DOCS) -> Model:
    """A model from the labelled documents; with none, a model that calls every text ``und``."""
    return train(*training_sample(train_docs, lang, text, doc_id, per_lang))


def identify(docs: DataFrame, model: Model, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns with ``lang_pred`` and ``score`` (0 to 1), a row for each row of ``docs``.

    Only the text is an input, and all of it. Null texts and texts without a letter are ``und`` with score 0, all are if the
    model has no languages. Ties go to the language first by name. Repeated rows stay; other columns are ignored.
    """
    found = docs.select(*(keep or ["doc_id"]), predict(model)(F.col(text)).alias("found__"))
    return found.select(*(keep or ["doc_id"]), "found__.lang_pred", "found__.score")
