"""Language ID by unigram pieces: a text's probability sums over all segmentations of its words.

Each language has a probability per piece of a fixed public vocabulary.  A word's probability is the sum
over all ways to cut it into pieces of the product of their probabilities (the forward algorithm), a
text's the product over its words.  The piece probabilities are learned by expectation-maximisation,
whose expected counts sum over all segmentations as well.
"""

from __future__ import annotations

import copy
import re
from collections import Counter
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .base import keep, lean, text_or_empty

#: EM steps, pseudo-count of a piece, and the probability of a letter that no piece has.
STEPS, SMOOTHING, UNKNOWN = 2, 0.1, 1e-8
#: A run of more letters is scored as several words.
LONGEST = 32
#: Word scores that a worker keeps; others are computed again when they return.
REMEMBERED = 120_000
#: Words that are cut together, and different words that a task counts before it passes them on.
TOGETHER, COUNTED = 8192, 50_000
#: A model and its remembered scores may take so many bytes in a task; more languages are refused.
MOST_BYTES = 512 << 20
UNDECIDED = "und"
#: What a language's texts look like is measured on all its labelled documents, if there are SEEN or more: each of
#: FOLDS parts is judged by a model of the others.
FOLDS, SEEN = 5, 5
#: A text is foreign if its mean log-probability per letter is below the range by more than the range's width
#: (SLACK at least), and over all its letters by EVIDENCE, so that a few letters never decide.
SLACK, EVIDENCE = 1.0, 10.0

_LETTERS = re.compile(r"[^\W\d_]{1,%d}" % LONGEST)
_START = "▁"


def words_of(text: str) -> list[str]:
    return _LETTERS.findall(text.lower())


def vocabulary_pieces(path: str) -> list[str]:
    """The pieces of lower-case letters, with or without the mark of a word's start, in the file's order."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    found = (model.id_to_piece(i) for i in range(model.get_piece_size()))
    return list(dict.fromkeys(p for p in found if p.removeprefix(_START) and _LETTERS.fullmatch(p.removeprefix(_START)) and p == p.lower()))


class Pieces:
    """Rows of probabilities by piece; row 0 is "no piece", row 1 an unknown letter.

    ``probabilities``: (piece, language), or (piece, language, model).  The pieces are kept as a trie in arrays: its
    nodes are numbered from the root, 0, and its edges sorted by (node, letter), so that all words walk it together.
    """

    def __init__(self, names: Sequence[str], probabilities: np.ndarray):
        edges: dict[tuple[int, int], int] = {}
        ends = {}
        for k, name in enumerate(names):
            node = 0
            for letter in map(ord, name):
                node = edges.setdefault((node, letter), len(edges) + 1)
            ends[node] = k + 2
        letters = sorted({letter for _, letter in edges})
        #: Number of a letter by code point; 0 for those of no piece.
        self.letter = np.zeros(max(letters, default=0) + 2, dtype=np.int64)
        self.letter[letters] = np.arange(1, len(letters) + 1)
        self.letters = len(letters) + 1
        key = np.array([node * self.letters + self.letter[letter] for node, letter in edges], dtype=np.int64)
        order = np.argsort(key)
        self.edge, self.child = np.append(key[order], np.iinfo(np.int64).max), np.append(np.array([*edges.values()], dtype=np.int64)[order], 0)
        self.row = np.zeros(len(edges) + 1, dtype=np.int64)
        self.row[list(ends)] = list(ends.values())
        self.longest = max(map(len, names), default=1)
        self.table = self._with_unknown(probabilities)

    @staticmethod
    def _with_unknown(probabilities: np.ndarray) -> np.ndarray:
        rest = probabilities.shape[1:]
        return np.concatenate([np.zeros((1, *rest)), np.full((1, *rest), UNKNOWN), probabilities])

    def having(self, probabilities: np.ndarray) -> Pieces:
        """The same pieces with other probabilities."""
        other = copy.copy(self)
        other.table = self._with_unknown(probabilities)
        return other

    def of_model(self, model: int) -> Pieces:
        other = copy.copy(self)
        other.table = np.ascontiguousarray(self.table[:, :, model])
        return other

    def _step(self, nodes: np.ndarray, letters: np.ndarray) -> np.ndarray:
        """Children of nodes, 0 if there is none."""
        key = nodes * self.letters + letters
        at = np.searchsorted(self.edge, key)
        return np.where(self.edge[at] == key, self.child[at], 0)

    def lattice(self, words: list[str]) -> tuple[np.ndarray, list[tuple[int, int, np.ndarray, np.ndarray]]]:
        """Lengths of marked words, and (start, end, words that have a piece there, its rows) in this order."""
        lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        count, size = len(words), int(lengths.max())
        inside = np.arange(size) < lengths[:, None]
        points = np.frombuffer("".join(words).encode("utf-32-le"), dtype=np.uint32)
        letters = np.zeros((count, size), dtype=np.int64)
        letters[inside] = self.letter[np.minimum(points, len(self.letter) - 1)]
        # Places in the order of (start, word); all walk down the trie until it has no such piece.
        letters, at = letters.T.ravel(), np.flatnonzero(inside.T)
        nodes = self._step(np.zeros(len(at), dtype=np.int64), letters[at])
        found: list[list] = [[] for _ in range(size)]
        for length in range(1, min(self.longest, size) + 1):
            rows = self.row[nodes] if length > 1 else np.maximum(self.row[nodes], 1)  # any letter alone
            hit = np.flatnonzero(rows)
            places, rows = at[hit], rows[hit]
            bounds = np.searchsorted(places, np.arange(size + 1) * count)
            for start in np.flatnonzero(np.diff(bounds)).tolist():
                part = slice(bounds[start], bounds[start + 1])
                found[start].append((start, start + length, places[part] - start * count, rows[part]))
            alive = np.flatnonzero((nodes > 0) & (at < (size - length) * count))
            at = at[alive]
            nodes = self._step(nodes[alive], letters[at + length * count])
            alive = np.flatnonzero(nodes)
            at, nodes = at[alive], nodes[alive]
            if not len(at):
                break
        return lengths, [entry for entries in found for entry in entries]

    def forward(self, lengths: np.ndarray, lattice: list, probabilities: Callable) -> np.ndarray:
        """Sums over the segmentations of each prefix: (place, word, column)."""
        width = self.table.shape[-1]
        sums = np.zeros((int(lengths.max()) + 1, len(lengths), width))
        sums[0] = 1
        for start, end, at, rows in lattice:
            sums[end, at] += sums[start, at] * probabilities(at, rows)
        return sums

    @staticmethod
    def _parts(words: list[str]) -> Iterator[np.ndarray]:
        """Places of words of like length, a bounded number at a time."""
        order = np.argsort(np.fromiter(map(len, words), dtype=np.int64, count=len(words)), kind="stable")
        yield from (order[a : a + TOGETHER] for a in range(0, len(order), TOGETHER))

    def log_probability(self, words: list[str]) -> np.ndarray:
        """(word, language) for distinct words without the mark."""
        out = np.empty((len(words), self.table.shape[1]))
        for part in self._parts(words):
            lengths, lattice = self.lattice([_START + words[k] for k in part])
            sums = self.forward(lengths, lattice, lambda at, rows: self.table[rows])
            out[part] = np.log(sums[lengths, np.arange(len(part))])
        return out

    def expected(self, words: list[str], counts: np.ndarray, langs: np.ndarray | None = None) -> np.ndarray:
        """Expected piece counts (row, language) of words that occur counts[word, language] times; of words of
        one language each, ``langs``, and counts[word, model], (row, language, model)."""
        columns = self.table.shape[1] if langs is None else int(langs.max()) + 1
        width = 1 if langs is None else columns
        total = np.zeros((counts.shape[1], len(self.table) * width))
        for part in self._parts(words):
            lengths, lattice = self.lattice([_START + words[k] for k in part])
            lang = None if langs is None else langs[part]
            shared = self.table.ndim == 3 and self.table.shape[1] == 1  # one column for all languages
            of = lambda at, rows: self.table[rows] if lang is None else self.table[rows, 0 if shared else lang[at]]  # noqa: E731, B023
            ahead = self.forward(lengths, lattice, of)
            back = np.zeros((*ahead.shape[:2], counts.shape[1]))
            ends = lengths, np.arange(len(part))
            back[ends] = counts[part] / ahead[ends]
            for start, end, at, rows in reversed(lattice):
                flow = of(at, rows) * back[end, at]
                back[start, at] += flow
                flow *= ahead[start, at]
                place = rows if lang is None else rows * width + lang[at]
                for k, column in enumerate(flow.T):
                    np.add.at(total[k], place, np.ascontiguousarray(column))
        return total.T if langs is None else total.T.reshape(len(self.table), width, -1)


def _word_counts(known: DataFrame, folds: int = 0) -> DataFrame:
    """lang, word, n over all rows, and ``n0``.. of each fold if ``folds`` are asked for; one row per word of a language."""

    def found_in(counters: dict[tuple, Counter]) -> pa.RecordBatch:
        parts, langs = ([key[k] for key, counter in counters.items() for _ in counter] for k in (0, 1))
        words, n = [w for c in counters.values() for w in c], [n for c in counters.values() for n in c.values()]
        columns = [pa.array(parts, pa.int32()), pa.array(langs, pa.string()), pa.array(words, pa.string()), pa.array(n, pa.int64())]
        return pa.RecordBatch.from_arrays(columns, names=["fold", "lang", "word", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[tuple, Counter] = {}
        for batch in batches:
            for part in (batch.slice(a, 64) for a in range(0, batch.num_rows, 64)):
                for fold, lang, text in zip(*(part.column(c).to_pylist() for c in ("fold", "lang", "text")), strict=True):
                    found.setdefault((fold, lang), Counter()).update(words_of(text))
                if sum(map(len, found.values())) >= COUNTED:
                    yield found_in(found)
                    found = {}
        yield found_in(found)

    fold = F.col("fold") if folds else F.lit(0).alias("fold")
    found = known.select(fold, "lang", "text").mapInArrow(lean(run), "fold int, lang string, word string, n long")
    of_fold = [F.sum(F.when(F.col("fold") == k, F.col("n")).otherwise(0)).alias(f"n{k}") for k in range(folds)]
    tasks = known.sparkSession.sparkContext.defaultParallelism
    return keep(found.groupBy("lang", "word").agg(F.sum("n").alias("n"), *of_fold), "word-counts").repartition(tasks, "lang", "word")


def _em_step(counts: DataFrame, pieces: Pieces, langs: list[str], models: Sequence[Column]) -> np.ndarray:
    """One EM step of all models over the word counts: (piece, language, model).  The driver gets pieces times
    languages times models, whatever the texts."""
    columns = [f"n{k}" for k in range(len(models))]
    model = counts.sparkSession.sparkContext.broadcast((pieces, langs))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces, langs = model.value
        total = np.zeros((len(pieces.table), len(langs), len(columns)))
        column = {lang: k for k, lang in enumerate(langs)}
        for batch in batches:
            if batch.num_rows:
                n = np.column_stack([batch.column(c).to_numpy() for c in columns])
                lang = np.array([column[x] for x in batch.column("lang").to_pylist()])
                part = pieces.expected(batch.column("word").to_pylist(), n, lang)
                total[:, : part.shape[1]] += part
        rows, cols = np.nonzero(total[2:].any(axis=2))
        found = [pa.array(rows.astype(np.int32)), pa.array(cols.astype(np.int32)), *map(pa.array, total[2:][rows, cols].T)]
        yield pa.RecordBatch.from_arrays(found, names=["piece", "lang", *columns])

    wanted = counts.select("lang", "word", *[m.cast("double").alias(c) for m, c in zip(models, columns, strict=True)])
    found = wanted.mapInArrow(lean(run), ", ".join(["piece int, lang int", *(f"{c} double" for c in columns)]))
    found = found.groupBy("piece", "lang").agg(*[F.sum(c).alias(c) for c in columns]).toArrow()
    model.destroy()
    out = np.full((len(pieces.table) - 2, len(langs), len(columns)), SMOOTHING)
    out[found.column("piece").to_numpy(), found.column("lang").to_numpy()] += np.column_stack([found.column(c).to_numpy() for c in columns])
    return out / out.sum(axis=0)


def _known(docs: DataFrame) -> DataFrame:
    """doc_id, lang, text and fold of the rows with a text and a lang."""
    fold = F.pmod(F.xxhash64(F.lit("fold"), "doc_id"), F.lit(FOLDS)).cast("int")
    return docs.where("lang is not null and text is not null").select("doc_id", "lang", "text", fold.alias("fold"))


def _languages(known: DataFrame) -> list[str]:
    return sorted(r["lang"] for r in known.select("lang").distinct().collect())


def _fit(counts: DataFrame, langs: list[str], names: list[str], models: Sequence[Column]) -> np.ndarray:
    """Probabilities of the pieces by language and model, whose counts are ``models``; a model must fit a task.

    A step learns all models in one pass over the words, or as many as take a quarter of MOST_BYTES.
    """
    size = (len(names) + REMEMBERED) * len(langs) * 8
    if size > MOST_BYTES:
        raise ValueError(f"a model of {len(langs)} languages takes {size >> 20} MB in each task; merge the spellings in lang")
    start = Pieces(names, np.full((len(names), 1, 1), 1.0 / max(len(names), 1)))
    together = max(1, MOST_BYTES // (4 * 8 * max(len(names), 1) * len(langs)))
    found = []
    for part in (models[a : a + together] for a in range(0, len(models), together)):
        pieces = start
        for _ in range(STEPS):
            pieces = pieces.having(_em_step(counts, pieces, langs, part))
        found.append(pieces.table[2:])
    return np.concatenate(found, axis=2)


def train(docs: DataFrame, vocabulary: str | None = None) -> tuple[list[str], list[str], np.ndarray]:
    """(languages, pieces, probabilities) from all rows of ``docs`` with a text and a lang.

    Every text is counted; the steps run over the distinct words.  The model has the size of the vocabulary
    times the languages, which is checked.
    """
    known = _known(docs)
    langs, names = _languages(known), vocabulary_pieces(vocabulary or public_tokenizers.path("piece_bpe_32k.model"))
    if not langs:
        return [], names, np.empty((len(names), 0))
    return langs, names, _fit(_word_counts(known), langs, names, [F.col("n")])[:, :, 0]


class _Judge:
    """Log-probabilities of texts by one model; the scores of ``most`` words are remembered."""

    def __init__(self, pieces: Pieces, most: int):
        self.pieces, self.most, self.place = pieces, most, {}
        self.scores = np.zeros((most, pieces.table.shape[1]))

    def totals(self, texts: list[Counter]) -> list[np.ndarray]:
        """By language, of texts that have words."""
        place, scores = self.place, self.scores
        new = list(dict.fromkeys(w for counts in texts for w in counts if w not in place))
        fresh = self.pieces.log_probability(new) if new else scores[:0]
        room = min(len(new), self.most - len(place))
        scores[len(place) : len(place) + room] = fresh[:room]
        place.update(zip(new[:room], range(len(place), len(place) + room), strict=True))
        extra = {w: k for k, w in enumerate(new[room:], self.most)}
        rows = np.vstack([scores, fresh[room:]]) if extra else scores
        found = []
        for counts in texts:
            at = np.fromiter((place[w] if w in place else extra[w] for w in counts), dtype=np.int64, count=len(counts))
            found.append(np.fromiter(counts.values(), dtype=np.float64, count=len(counts)) @ rows[at])
        return found


def predict(
    docs: DataFrame, langs: list[str], names: list[str], table: np.ndarray, carry: Sequence[str] = ("doc_id",), fit: bool = False,
    model: str | None = None,
) -> DataFrame:
    """``carry``, lang_pred and score for each row, one pass over whole texts without a shuffle; with ``fit``
    also ``_letters`` and ``_fit``, the mean log-probability per letter in the predicted language.

    ``table``: (piece, language), or (piece, language, model) with a column ``model`` that numbers the row's model.
    The score is the posterior of the predicted language under equal priors, 0 for "und": NULL text, a
    text without a letter, or a model without languages.  Ties go to the first language by name.
    """
    table = table if model else table[:, :, None]
    shared = docs.sparkSession.sparkContext.broadcast((langs, Pieces(names, table)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, pieces = shared.value
        models = pieces.table.shape[2]
        judges: dict[int, _Judge] = {}
        for batch in batches:
            for a in range(0, batch.num_rows, 256):
                texts = batch.column("text").slice(a, 256).to_pylist()
                part = [Counter(words_of(t)) if t and known else Counter() for t in texts]
                which = batch.column(model).slice(a, 256).to_pylist() if model else [0] * len(part)
                judged: dict[int, np.ndarray] = {}
                for k in sorted({m for m, counts in zip(which, part, strict=True) if counts}):
                    judge = judges.get(k) or judges.setdefault(k, _Judge(pieces.of_model(k), REMEMBERED // models))
                    at = [i for i, counts in enumerate(part) if counts and which[i] == k]
                    judged.update(zip(at, judge.totals([part[i] for i in at]), strict=True))
                preds, sure, letters, fits = [], [], [], []
                for i, counts in enumerate(part):
                    if not counts:
                        preds.append(UNDECIDED)
                        sure.append(0.0)
                        letters.append(0)
                        fits.append(0.0)
                        continue
                    total = judged[i]
                    best = int(np.argmax(total))
                    preds.append(known[best])
                    sure.append(float(1 / np.exp(total - total[best]).sum()))
                    letters.append(sum(len(w) * n for w, n in counts.items()) if fit else 0)
                    fits.append(float(total[best]) / max(letters[-1], 1))
                columns = [batch.column(c).slice(a, len(part)) for c in carry]
                columns += [pa.array(preds, pa.string()), pa.array(sure, pa.float64())]
                columns += [pa.array(letters, pa.int64()), pa.array(fits, pa.float64())] if fit else []
                yield pa.RecordBatch.from_arrays(columns, names=[*carry, "lang_pred", "score", *added])

    added = ["_letters", "_fit"] if fit else []
    fields = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in carry) + ", lang_pred string, score double"
    fields += ", _letters long, _fit double" if fit else ""
    return docs.select(*dict.fromkeys([*carry, "text", *([model] if model else [])])).mapInArrow(lean(run), fields)


def held_out(doc_id: Column) -> Column:
    """Documents that nothing is learned from."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(4)) == 2


def identify(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score, one row per row of ``docs``; learns from the rest only.

    Reads doc_id, text and lang (lang for learning alone).  An empty table gives an empty result.
    """
    model = train(docs.where(~held_out(F.col("doc_id"))))
    return predict(docs, *model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def least_fits(known: DataFrame, langs: list[str], names: list[str], table: np.ndarray) -> dict[str, float]:
    """By language, the ``_fit`` below which a text is not of it.

    All labelled documents are judged, each by a model learned without its fold, whose number it has in ``table``: unseen
    texts score lower than learned ones.  Their range goes from the 1st to the 99th percentile.  A language with fewer
    than SEEN of them has no entry.
    """
    judged = predict(known, langs, names, table, carry=("lang",), fit=True, model="fold").where("lang = lang_pred")
    ends = F.percentile_approx("_fit", [0.01, 0.99], 10_000).alias("ends")
    found = judged.groupBy("lang").agg(ends, F.count(F.lit(1)).alias("n")).where(F.col("n") >= SEEN).collect()
    return {r["lang"]: r["ends"][0] - max(r["ends"][1] - r["ends"][0], SLACK) for r in found}


def known_language(docs: DataFrame, least: float = 0.5) -> DataFrame:
    """The rows of ``docs``, all columns, except those without a language or with a score below ``least``, and
    those that look like none of the languages (:func:`least_fits`; the score alone compares the learned
    languages, and one of them wins any text).  All rows if no row to learn from has a language.  Each row is
    judged by its own text, whatever its doc_id.  Any column name may occur beside doc_id, text and lang."""
    learned = _known(docs.where(~held_out(F.col("doc_id"))))
    langs, names = _languages(learned), vocabulary_pieces(public_tokenizers.path("piece_bpe_32k.model"))
    if not langs:
        return docs
    # A model without each fold, and one of them all; they learn together.
    counts = [F.col("n") - F.col(f"n{k}") for k in range(FOLDS)]
    table = _fit(_word_counts(learned, FOLDS), langs, names, [*counts, F.col("n")])
    model = langs, names, np.ascontiguousarray(table[:, :, FOLDS])
    short = F.lit(0.0)
    for lang, fit in least_fits(learned, langs, names, table[:, :, :FOLDS]).items():
        short = F.when(F.col("lang_pred") == lang, (F.lit(fit) - F.col("_fit")) * F.col("_letters")).otherwise(short)
    # Numbered names, as a column may have the name of a result.
    renamed = {c: c if c == "text" else f"c{k}" for k, c in enumerate(docs.columns)}
    judged = predict(docs.toDF(*renamed.values()), *model, carry=list(renamed.values()), fit=True)
    known = judged.where((F.col("lang_pred") != UNDECIDED) & (F.col("score") >= least) & (short <= EVIDENCE))
    return known.select(*(F.col(n).alias(c) for c, n in renamed.items()))
