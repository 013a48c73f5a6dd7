"""Language ID by unigrams over a fixed public vocabulary, summed over all segmentations.

Text is lower-cased; words are runs of letters. A language gives each piece of
the vocabulary a probability, and a word the sum over all ways to put it
together from pieces, found by a forward pass. Pieces don't cross words, so a
text's likelihood is the product over its words. A byte without a piece is a
piece of its own kind.

Probabilities are expected piece counts of one forward-backward pass over all
labelled documents, from equal piece probabilities, with ``SMOOTH`` added to
each. Tasks count their distinct words by language, Spark sums those counts, and the
pass takes each distinct word of the corpus once, whole, however long it is: sums along
words of ``LONG`` bytes or more are scaled as they go. Only the summed counts (languages x
pieces, bounded by the vocabulary) reach the driver. Scores of words are
kept for the life of a Python worker, up to ``KEEP_BYTES``.

A text without a letter, empty or null is ``und`` with score 0. The score is the
posterior of the predicted language given the shares of the learned languages;
ties go to the first in alphabetical order. Where no labelled document has a
word, every text is ``und``.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.llm import textbytes as tb
from riskloom.llm.segments import for_worker

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
SMOOTH = 0.1
LONG = 48  # bytes with the space; longer words are scaled while they are summed
SCALED = 8  # places between two scalings
WORDS_AT_ONCE = 1 << 15
LONG_AT_ONCE = 1 << 18  # bytes of long words
COUNTED = 1 << 18  # distinct words a task holds
KEEP_BYTES = 1 << 26  # of words' scores in a worker
CHUNK = 1 << 21
START = 0x20


def read_pieces(path: str) -> list[bytes]:
    """Lower-cased pieces made of letters, with a leading space where they begin a word."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    found = set()
    letters = tb.word_table(letters=True) != 0
    for i in range(model.get_piece_size()):
        if model.is_control(i) or model.is_unknown(i) or model.is_byte(i):
            continue
        piece = model.id_to_piece(i).lower()
        raw = piece.replace("▁", " ").encode()
        body = raw[1:] if raw[:1] == b" " else raw
        if (body or raw) and letters[np.frombuffer(body, np.uint8)].all():
            found.add(raw)
    return sorted(found)


class Lattice:
    """Pieces by hash, and passes over the segmentations of many words at once."""

    def __init__(self, pieces: list[bytes]):
        self.n = len(pieces) + 1  # the last is any single byte
        flat = np.frombuffer(b"".join(pieces), np.uint8)
        ends = np.cumsum([len(p) for p in pieces])
        starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
        hashes = self._hash(self._sums(flat), starts, ends)
        by = np.argsort(hashes)
        self.hashes, self.ids = hashes[by], by
        self.longest = max(map(len, pieces))
        self.sieve = np.zeros(1 << 20, bool)
        self.sieve[self.hashes >> np.uint64(44)] = True

    @staticmethod
    def _sums(flat):
        p, _ = tb.powers(len(flat) + 1)
        out = np.zeros(len(flat) + 1, np.uint64)
        np.cumsum((flat.astype(np.uint64) + np.uint64(1)) * p[: len(flat)], out=out[1:])
        return out

    @staticmethod
    def _hash(sums, starts, ends):
        _, q = tb.powers(len(sums))
        return tb.mix((sums[ends] - sums[starts]) * q[starts] + (ends - starts).astype(np.uint64))

    def edges(self, flat: np.ndarray, begin: np.ndarray, size: np.ndarray):
        """All pieces in words laid end to end: (end, length, piece), ordered by place in the word."""
        sums = self._sums(flat)
        place = np.arange(len(flat)) - np.repeat(begin, size) + 1  # bytes of the word up to here
        ends, lengths, ids = [], [], []
        stop = np.arange(1, len(flat) + 1)
        for k in range(1, self.longest + 1):
            ok = place >= k
            e = stop[ok]
            h = self._hash(sums, e - k, e)
            some = self.sieve[(h >> np.uint64(44)).astype(np.int64)]
            e, h = e[some], h[some]
            at = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
            hit = self.hashes[at] == h
            ends.append(e[hit])
            lengths.append(np.full(hit.sum(), k))
            ids.append(self.ids[at[hit]])
        ends.append(stop)  # any byte
        lengths.append(np.ones(len(stop), np.int64))
        ids.append(np.full(len(stop), self.n - 1))
        ends, lengths, ids = map(np.concatenate, (ends, lengths, ids))
        at = place[ends - 1]
        by = np.argsort(at * np.int64(len(flat) + 1) + ends, kind="stable")  # by place, then by word
        ends, lengths, ids = ends[by], lengths[by], ids[by]
        return ends, lengths, ids, np.searchsorted(at[by], np.arange(1, place.max() + 2))

    def forward(self, flat, begin, size, prob, scaled: bool = False):
        """Sums over segmentations up to each byte, ``[bytes + 1 a word, columns of prob]``.

        Row ``begin + word number`` is a word's start; each word has one row more than bytes.
        With ``scaled``, the logarithms that the rows were divided by come too, else 0.
        """
        ends, lengths, ids, edge = self.edges(flat, begin, size)
        word = np.repeat(np.arange(len(begin)), size)
        to = ends + word[ends - 1]
        first = np.flatnonzero(np.r_[True, to[1:] != to[:-1]]) if len(to) else np.zeros(0, np.int64)
        group = np.searchsorted(first, edge)  # every byte is an edge, so every place has its words' rows
        alpha = np.zeros((len(flat) + len(begin), prob.shape[1]))
        start = begin + np.arange(len(begin))
        alpha[start] = 1
        scale = np.zeros_like(alpha) if scaled else 0
        for k, (a, b, x, y) in enumerate(zip(edge[:-1], edge[1:], group[:-1], group[1:], strict=True), 1):
            rows = to[first[x:y]]
            if scaled:
                scale[rows] = scale[rows - 1]
                alive = rows
            alpha[rows] = np.add.reduceat(alpha[to[a:b] - lengths[a:b]] * prob[ids[a:b]], first[x:y] - a, axis=0)
            if scaled and k % SCALED == 0:  # keep the rows that later ones read near 1
                back = np.minimum(k, self.longest)
                top = np.max([alpha[alive - j] for j in range(back + 1)], axis=0)
                for j in range(back + 1):
                    alpha[alive - j] /= top
                    scale[alive - j] += np.log(top)
        return alpha, (to, lengths, ids, edge, first, group), scale

    def word_scores(self, flat, begin, size, prob, scaled: bool = False) -> np.ndarray:
        """Log of the summed probability of each word; words of ``LONG`` bytes or more need ``scaled``."""
        alpha, _, scale = self.forward(flat, begin, size, prob, scaled)
        last = begin + np.arange(len(begin)) + size
        return np.log(alpha[last]) + (scale[last] if scaled else 0)

    def expected(self, flat, begin, size, prob, weight, scaled: bool = False) -> np.ndarray:
        """Expected piece counts ``[columns of weight, pieces]`` of words under one distribution."""
        alpha, (to, lengths, ids, edge, _, _), up = self.forward(flat, begin, size, prob[:, None], scaled)
        alpha = alpha[:, 0]
        beta, down = np.zeros(len(alpha)), np.zeros(len(alpha))
        last = begin + np.arange(len(begin)) + size
        beta[last] = 1
        word = np.searchsorted(last, to)
        start = begin + np.arange(len(begin))
        now = np.zeros(len(begin))  # what the rows still to be read are divided by
        for t, (a, b) in zip(range(len(edge) - 1, 0, -1), zip(edge[:-1][::-1], edge[1:][::-1], strict=True), strict=True):
            if scaled:
                alive = np.flatnonzero(size >= t)
                rows = start[alive] + t
                if t % SCALED == 0:
                    back = range(min(self.longest, t) + 1)
                    top = np.max([beta[rows - j] for j in back], axis=0)
                    for j in back:
                        beta[rows - j] /= top
                    now[alive] += np.log(top)
                down[rows] = now[alive]
            np.add.at(beta, to[a:b] - lengths[a:b], beta[to[a:b]] * prob[ids[a:b]])
        share = alpha[to - lengths] * prob[ids] * beta[to] / alpha[last][word]
        if scaled:
            up = up[:, 0]
            share *= np.exp(up[to - lengths] + down[to] - up[last][word])
        return np.stack([np.bincount(ids, weights=share * w[word], minlength=self.n) for w in weight.T])


def _laid(data, starts, ends):
    """Words with a space before each, end to end."""
    size = ends - starts + 1
    begin = np.cumsum(size) - size
    flat = np.full(size.sum(), START, np.uint8)
    body = np.arange(len(flat)) - np.repeat(begin, size)
    inside = body > 0
    flat[inside] = data[(np.repeat(starts, size) + body - 1)[inside]]
    return flat, begin, size


def _distinct(data, starts, ends, hashes):
    _, first, inverse = np.unique(hashes, return_index=True, return_inverse=True)
    return starts[first], ends[first], inverse


def _parts(size):
    """Index arrays of words that are summed at once, and whether they are scaled; ``size`` with the space."""
    short = np.flatnonzero(size < LONG)
    for a in range(0, len(short), WORDS_AT_ONCE):
        yield short[a: a + WORDS_AT_ONCE], False
    long = np.flatnonzero(size >= LONG)
    long = long[np.argsort(size[long], kind="stable")]
    total = np.cumsum(size[long])
    a = 0
    while a < len(long):
        b = max(a + 1, int(np.searchsorted(total, (total[a - 1] if a else 0) + LONG_AT_ONCE, "right")))
        yield long[a:b], True
        a = b


def _lower(column):
    arr = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return pc.utf8_lower(arr.cast(pa.large_string()))


def _word_rows(langs: list[str]):
    """Labelled texts to distinct words with their counts, one row for each word and language of a task."""
    def run(batches):
        tb.lean()
        table = tb.word_table(letters=True)
        index = {x: i for i, x in enumerate(langs)}
        held: dict[tuple[int, bytes], int] = {}

        def flushed():
            lang, word = zip(*held, strict=True)
            out = pa.RecordBatch.from_arrays([pa.array(lang, pa.int32()), pa.array(word, pa.binary()), pa.array(list(held.values()), pa.int64())], names=["lang", "word", "n"])
            held.clear()
            return out

        for b in batches:
            own = np.array([index[x] for x in b.column(0).to_pylist()], np.int64)
            for r0, _, data, offsets in tb.chunks(_lower(b.column(1)), CHUNK):
                starts, ends, hashes, first = tb.words(data, offsets, table)
                if not len(starts):
                    continue
                lang = np.repeat(own[r0: r0 + len(offsets) - 1], np.diff(first))
                s, e, inverse = _distinct(data, starts, ends, hashes)
                key, n = np.unique(inverse * len(langs) + lang, return_counts=True)
                raw = data.tobytes()
                word = [raw[x:y] for x, y in zip(s.tolist(), e.tolist(), strict=True)]
                for k, c in zip(key.tolist(), n.tolist(), strict=True):
                    of = (k % len(langs), word[k // len(langs)])
                    held[of] = held.get(of, 0) + c
                if len(held) > COUNTED:
                    yield flushed()
        if held:
            yield flushed()
    return run


def _count_rows(pieces: list[bytes], n_langs: int):
    """Words with their counts (a list over languages) to expected piece counts, one row for each language and piece of a task."""
    def run(batches):
        tb.lean()
        lattice = Lattice(pieces)
        equal = np.full(lattice.n, 1 / lattice.n)
        total = np.zeros((n_langs, lattice.n))
        for b in batches:
            word = b.column(0)
            size = np.array([len(w) for w in word.to_pylist()], np.int64)
            n = b.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, n_langs).astype(float)
            raw = np.frombuffer(b"".join(word.to_pylist()), np.uint8)
            end = np.cumsum(size)
            for part, scaled in _parts(size + 1):
                total += lattice.expected(*_laid(raw, (end - size)[part], end[part]), equal, n[part], scaled)
        lang, piece = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(lang), pa.array(piece), pa.array(total[lang, piece])], names=["lang", "piece", "n"])
    return run


class _Scores:
    """Scores of words by their hash, sorted, kept up to ``KEEP_BYTES``."""

    def __init__(self, name: str, pieces: list[bytes], prob: np.ndarray):
        self.name, self.lattice, self.prob = name, Lattice(pieces), prob
        self.most = KEEP_BYTES // (8 * (prob.shape[1] + 1))
        self._clear()

    def _clear(self):
        self.hashes, self.rows = np.zeros(0, np.uint64), np.zeros((0, self.prob.shape[1]))

    def __call__(self, data, starts, ends, hashes) -> np.ndarray:
        """Scores of distinct words, given by their bytes and hashes in ascending order."""
        at = np.searchsorted(self.hashes, hashes)
        known = np.zeros(len(hashes), bool)
        inside = at < len(self.hashes)
        known[inside] = self.hashes[at[inside]] == hashes[inside]
        score = np.empty((len(hashes), self.prob.shape[1]))
        score[known] = self.rows[at[known]]
        new = np.flatnonzero(~known)
        for part, scaled in _parts((ends - starts)[new] + 1):
            of = new[part]
            score[of] = self.lattice.word_scores(*_laid(data, starts[of], ends[of]), self.prob, scaled)
        if len(self.hashes) + len(new) > self.most:
            self._clear()
            new = np.arange(len(hashes))[: self.most]
        where = np.searchsorted(self.hashes, hashes[new])
        self.hashes, self.rows = np.insert(self.hashes, where, hashes[new]), np.insert(self.rows, where, score[new], axis=0)
        return score


def _predict_rows(pieces: list[bytes], langs: list[str], prob: np.ndarray, prior: np.ndarray, n: int, names: list[str], name: str):
    def run(batches):
        tb.lean()
        table = tb.word_table(letters=True)
        held = for_worker("languages", dict)  # of the last model only
        if name not in held:
            held.clear()
            held[name] = _Scores(name, pieces, prob)
        scores = held[name]
        for b in batches:
            rows = b.num_rows
            loglik = np.tile(np.log(prior), (rows, 1)) if len(langs) else np.zeros((rows, 1))
            heard = np.zeros(rows, bool)
            for r0, r1, data, offsets in tb.chunks(_lower(b.column(n)), CHUNK):
                starts, ends, hashes, first = tb.words(data, offsets, table)
                if not len(starts):
                    continue
                plain = np.concatenate([[0], np.cumsum((data >= 97) & (data <= 122))])
                latin = plain[offsets[1:]] > plain[offsets[:-1]]
                for i in np.flatnonzero(~latin & (np.diff(first) > 0)):
                    latin[i] = any(c.isalpha() for c in data[offsets[i]: offsets[i + 1]].tobytes().decode(errors="ignore"))
                heard[r0:r1] = latin
                if not len(langs):
                    continue
                s, e, inverse = _distinct(data, starts, ends, hashes)
                score = scores(data, s, e, np.unique(hashes))
                some = np.flatnonzero(np.diff(first))
                loglik[r0 + some] += np.add.reduceat(score[inverse], first[some], axis=0)
            best = loglik.argmax(axis=1)
            share = 1 / np.exp(loglik - loglik.max(axis=1, keepdims=True)).sum(axis=1)
            known = heard & (len(langs) > 0)
            lang = [langs[k] if ok else "und" for k, ok in zip(best.tolist(), known.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:n], pa.array(lang, pa.string()), pa.array(np.where(known, share, 0.0))], names=names)
    return run


def predicted(docs: DataFrame, learn: Column, text_col: str = "text", lang_col: str = "lang",
              vocabulary: str = VOCABULARY, smooth: float = SMOOTH) -> DataFrame:
    """All columns of ``docs`` but the text, with ``lang_pred`` and ``lang_score``.

    Learns from the rows where ``learn`` is true and the language isn't null.
    The languages themselves (a few hundred at most) reach the driver.
    """
    pieces = read_pieces(vocabulary)
    text = F.col(f"`{text_col}`").cast("string")
    taught = docs.where(learn & F.col(f"`{lang_col}`").isNotNull()).select(F.col(f"`{lang_col}`").cast("string").alias("lang"), F.coalesce(text, F.lit("")).alias("text"))
    shares = {r.lang: r["count"] for r in taught.groupBy("lang").count().collect()}
    langs = sorted(shares)
    counts = np.full((len(langs), len(pieces) + 1), smooth)
    if langs:
        said = taught.mapInArrow(_word_rows(langs), "lang int, word binary, n long")
        words = said.groupBy("word").agg(F.array(*[F.sum(F.when(F.col("lang") == i, F.col("n")).otherwise(0)) for i in range(len(langs))]).alias("n"))
        summed = words.mapInArrow(_count_rows(pieces, len(langs)), "lang long, piece long, n double").groupBy("lang", "piece").agg(F.sum("n").alias("n"))
        for r in summed.toLocalIterator():
            counts[r.lang, r.piece] += r.n
    prob = np.ascontiguousarray((counts / counts.sum(axis=1, keepdims=True)).T)
    prior = np.array([shares[x] for x in langs], float)
    rest = [c for c in docs.columns if c not in (text_col, "lang_pred", "lang_score")]
    given = docs.select(*[F.col(f"`{c}`") for c in rest], F.coalesce(text, F.lit("")).alias("__text"))
    schema = given.select(*[F.col(f"`{c}`") for c in rest]).schema.add("lang_pred", "string").add("lang_score", "double")
    return given.mapInArrow(_predict_rows(pieces, langs, prob, prior / max(prior.sum(), 1), len(rest), schema.names, uuid.uuid4().hex), schema)
