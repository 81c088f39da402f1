"""Language identification by segmentation-marginalised unigrams.

Each language has a probability for every piece of a fixed public vocabulary. The probability of a word
is the sum over all its segmentations into pieces, found by the forward algorithm; a text's is the
product over its words. The piece probabilities are fitted by expectation-maximisation
(forward-backward over the same lattices), each language's in a task of its own, on a bounded sample of the labelled training documents: about
``SAMPLE_PER_LANG`` of each language, dealt by a hash of the row, whatever their length. Of a document with
more than ``SAMPLE_WORDS`` words or ``SAMPLE_BYTES`` bytes of words that many are drawn at random from all
of its words. Predictions read whole texts. A run of more than ``WORD_BYTES`` bytes without white space is
scored as consecutive words of at most that many bytes.

Null or empty text, and text without a letter, is ``und`` with score 0, as is every text when no
document is labelled for training; ``drop_unidentified`` drops only text without a letter, then too. A null ``doc_id`` counts as remainder 0. Rows with the same
``doc_id`` are scored one by one; ties go to the language that sorts first; an empty table gives no rows;
other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import crc_mod, documents, numbered, ship, text_of
from .lattice import Lattices, read_pieces
from .word_table import LOWER_ASCII, WordTable, blank_words, text_bytes

SAMPLE_PER_LANG = 600
SAMPLE_WORDS = 1 << 14  # of a document
SAMPLE_BYTES = 1 << 17
WORD_BYTES = 48  # of a word in the sample; of a word whose sum is remembered
WINDOW = 32
RUN_BYTES = 1 << 20  # of long runs scored at once
ROUNDS = 4
UNKNOWN = 1e-7  # of a character that no piece covers
PRIOR = 0.05  # added to each piece's expected count
MOST_WORDS = 500_000  # a worker forgets its words beyond this number
LETTER = r"\p{L}"


def _vocabulary(path: str) -> dict[bytes, int]:
    """Distinct pieces with ASCII capitals folded, the mark of a word's start as a space."""
    pieces, _, at_byte, control = read_pieces(path)
    skip = {*at_byte, *control}
    folded = (LOWER_ASCII[np.frombuffer(p.replace("▁", " ").encode(), np.uint8)].tobytes()
              for i, p in enumerate(pieces) if i not in skip)
    return {p: k for k, p in enumerate(dict.fromkeys(folded))}


def _padded(buf: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The words, longest first, each after a space: bytes, starts, lengths and the order."""
    order = np.argsort(-lengths, kind="stable")
    size = lengths[order]
    to = np.cumsum(size + 1) - size
    out = np.zeros(int((size + 1).sum()) + 16, np.uint8)
    out[to - 1] = 32
    inside = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
    out[np.repeat(to, size) + inside] = buf[np.repeat(starts[order], size) + inside]
    return out, to - 1, size + 1, order


def _character_arcs(buf: np.ndarray, starts: np.ndarray, lengths: np.ndarray, window: int) -> Iterator[tuple[int, int, np.ndarray]]:
    """(position, length, words) of every character of the words at the first ``window`` positions."""
    for i in range(min(int(lengths[0]), window) if len(lengths) else 0):
        have = np.searchsorted(-lengths, -i)
        lead = buf[starts[:have] + i]
        size = np.where(lead < 0x80, 1, np.where(lead < 0xC0, 0, np.where(lead < 0xE0, 2, np.where(lead < 0xF0, 3, 4))))
        size = np.minimum(size, lengths[:have] - i)
        for n in range(1, 5):
            words = np.flatnonzero(size == n)
            if len(words):
                yield i, n, words


class PieceModel:
    """Log probabilities of words in each language."""

    def __init__(self, vocabulary: dict[bytes, int], langs: list[str], probs: np.ndarray):
        self.lattices, self.langs, self.probs = Lattices(vocabulary), langs, probs

    def arcs(self, buf, starts, lengths, window: int) -> list[tuple[int, int, np.ndarray, np.ndarray | None]]:
        """All arcs from the first ``window`` positions by position; pieces None: the arcs of unknown characters."""
        found = list(self.lattices.walk_window(buf, starts, lengths, window))
        single = {(i, n): words for i, n, words, _ in found}
        for i, n, words in _character_arcs(buf, starts, lengths, window):
            lacks = np.setdiff1d(words, single.get((i, n), np.empty(0, np.int64)), assume_unique=True)
            if len(lacks):
                found.append((i, n, lacks, None))
        return sorted(found, key=lambda a: (a[0], a[1]))

    def weight(self, pieces: np.ndarray | None):
        return UNKNOWN if pieces is None else self.probs[pieces]

    def forward(self, arcs, count: int, longest: int) -> np.ndarray:
        alpha = np.zeros((longest + 1, count, len(self.langs)))
        alpha[0] = 1
        for i, n, words, pieces in arcs:
            alpha[i + n, words] += alpha[i, words] * self.weight(pieces)
        return alpha

    def log_probs(self, buf: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """The log of the sum over all segmentations of each word, a row of languages each."""
        out = np.empty((len(starts), len(self.langs)))
        most = max(64, min(4096, (1 << 15) // len(self.langs)))
        ends, at = np.cumsum(lengths), 0
        while at < len(starts):
            full = int(np.searchsorted(ends, RUN_BYTES + (ends[at - 1] if at else 0), side="right"))
            to = min(at + most, max(full, at + 1))
            words, begin, size, order = _padded(buf, starts[at:to], lengths[at:to])
            out[at + order] = self._carried(words, begin, size)
            at = to
        return out

    def _carried(self, buf: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Forward sums of words, longest first, window by window: sums at the states beyond a window are the next one's start."""
        out, scale = np.empty((len(starts), len(self.langs))), np.zeros((len(starts), len(self.langs)))
        beyond = max(self.lattices.most, 4)
        held = np.zeros((beyond, len(starts), len(self.langs)))
        held[0] = 1
        for i0 in range(0, int(lengths[0]) if len(lengths) else 0, WINDOW):
            have = int(np.searchsorted(-lengths, -i0))  # words longer than i0
            left = lengths[:have] - i0
            alpha = np.zeros((WINDOW + beyond, have, len(self.langs)))
            alpha[:beyond] = held[:, :have]
            for i, n, words, pieces in self.arcs(buf, starts[:have] + i0, left, WINDOW):
                alpha[i + n, words] += alpha[i, words] * self.weight(pieces)
            done = np.flatnonzero(left <= WINDOW)
            out[done] = np.log(np.maximum(alpha[left[done], done], 1e-300)) + scale[done]
            held = alpha[WINDOW:]
            top = np.maximum(held.max(axis=0), 1e-300)
            held = held / top
            scale[:have] += np.log(top)
        return out


def _cut_long(starts: np.ndarray, lengths: np.ndarray, buf: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words of at most ``WORD_BYTES`` bytes, cut between characters."""
    if not len(lengths) or lengths.max() <= WORD_BYTES:
        return starts, lengths, first
    new_starts, new_lengths, counts = [], [], np.ones(len(starts), np.int64)
    for k in np.flatnonzero(lengths > WORD_BYTES).tolist():
        a, end, own = int(starts[k]), int(starts[k] + lengths[k]), []
        while a < end:
            b = min(a + WORD_BYTES, end)
            while b < end and buf[b] & 0xC0 == 0x80:
                b -= 1
            own.append((a, b - a))
            a = b
        counts[k] = len(own)
        new_starts += [s for s, _ in own]
        new_lengths += [n for _, n in own]
    long = np.repeat(lengths > WORD_BYTES, counts)
    s, n = np.repeat(starts, counts), np.repeat(lengths, counts)
    s[long], n[long] = new_starts, new_lengths
    return s, n, np.concatenate([[0], np.cumsum(counts)])[first]


def fit_language(texts: list[str], vocabulary: dict[bytes, int]) -> np.ndarray:
    """Piece probabilities of one language by expectation-maximisation: a language's do not depend on the others'."""
    buf, offsets = text_bytes(pa.array(texts, pa.string()), LOWER_ASCII)
    starts, lengths, _ = _cut_long(*(lambda w: (w[0], w[1], buf, w[2]))(blank_words(buf, offsets)))
    table = WordTable()
    numbers, new = table.lookup(buf, starts, lengths)
    counts = np.bincount(numbers, minlength=table.n).astype(np.float64)[:, None]
    model = PieceModel(vocabulary, [""], np.full((len(vocabulary), 1), 1 / len(vocabulary)))
    for _ in range(ROUNDS):
        expected = np.full(model.probs.shape, PRIOR)
        for at in range(0, len(new), 4096):
            words, begin, size, order = _padded(buf, starts[new[at:at + 4096]], lengths[new[at:at + 4096]])
            arcs, weight, last = model.arcs(words, begin, size, int(size[0])), counts[at + order], np.arange(len(size))
            alpha = model.forward(arcs, len(size), int(size[0]))
            beta = np.zeros_like(alpha)
            beta[size, last] = weight / np.maximum(alpha[size, last], 1e-300)
            for i, n, words_at, pieces in reversed(arcs):
                through = beta[i + n, words_at] * model.weight(pieces)
                if pieces is not None:
                    np.add.at(expected, pieces, alpha[i, words_at] * through)
                beta[i, words_at] += through
        model.probs = expected / expected.sum(axis=0)
    return model.probs[:, 0]


def fit(sample: list[tuple[str, str]], vocabulary: dict[bytes, int], langs: list[str]) -> PieceModel:
    """The model of (lang, text) rows."""
    return PieceModel(vocabulary, langs, np.stack([fit_language([t for g, t in sample if g == lang], vocabulary) for lang in langs], axis=1))


def _fit_group(vocab: str):
    def run(rows: pa.Table) -> pa.Table:
        probs = fit_language(rows.column("text").to_pylist(), _vocabulary(vocab))
        return pa.table({"lang": rows.column("lang").slice(0, 1), "probs": pa.array([probs.tobytes()], pa.binary())})

    return run


def _thinned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, text) rows; of long texts randomly drawn words."""
    for whole in batches:
        for at in range(0, whole.num_rows, 256):
            batch = whole.slice(at, 256)
            buf, offsets = text_bytes(batch.column(1))
            words = blank_words(buf, offsets)
            starts, lengths, first = _cut_long(words[0], words[1], buf, words[2])
            size = np.diff(np.concatenate([[0], np.cumsum(lengths)])[first])
            texts = batch.column(1).to_pylist()
            for k in np.flatnonzero((np.diff(first) > SAMPLE_WORDS) | (size > SAMPLE_BYTES)).tolist():
                own = first[k] + np.random.default_rng(0).permutation(first[k + 1] - first[k])[:SAMPLE_WORDS]
                own = np.sort(own[np.cumsum(lengths[own]) <= SAMPLE_BYTES]).tolist()
                texts[k] = b" ".join(buf[starts[w]:starts[w] + lengths[w]].tobytes() for w in own).decode()
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["lang", "text"])


def _predict(shared, vocab: str, width: int, text: int):
    """The first ``width`` columns with the language of column ``text`` and its score; the last column tells whether it has a letter."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        langs, probs = shared.value
        model, table, logs = PieceModel(_vocabulary(vocab), langs, probs), WordTable(), [np.empty((1 << 16, len(langs)))]
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                if table.n > MOST_WORDS:
                    table.__init__()
                buf, offsets = text_bytes(batch.column(text), LOWER_ASCII)
                words = blank_words(buf, offsets)
                long, short = np.flatnonzero(words[1] > WORD_BYTES), np.flatnonzero(words[1] <= WORD_BYTES)
                starts, lengths = words[0][short], words[1][short]
                before = table.n
                numbers, new = table.lookup(buf, starts, lengths)
                if table.n > len(logs[0]):
                    logs[0] = np.concatenate([logs[0], np.empty((max(table.n, 2 * len(logs[0])) - len(logs[0]), len(model.langs)))])
                logs[0][before:table.n] = model.log_probs(buf, starts[new], lengths[new])
                doc = np.repeat(np.arange(batch.num_rows), np.diff(words[2]))
                own = model.log_probs(buf, words[0][long], words[1][long])  # long runs seldom come twice
                total = np.stack([np.bincount(doc[short], logs[0][numbers, g], batch.num_rows) + np.bincount(doc[long], own[:, g], batch.num_rows)
                                  for g in range(len(model.langs))], axis=1)
                best = total.argmax(axis=1)
                share = 1 / np.exp(np.minimum(total - total[np.arange(len(best)), best][:, None], 0)).sum(axis=1)
                letter = np.asarray(batch.column(batch.num_columns - 1))
                names = [model.langs[b] if ok else "und" for b, ok in zip(best.tolist(), letter.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns[:width], pa.array(names), pa.array(np.where(letter, share, 0.0))],
                    [*batch.schema.names[:width], "__lang", "__score"])

    return run


def train(docs: DataFrame, vocab: str, mod: int = 3, held: int = 1) -> PieceModel | None:
    """The model from labelled rows whose crc32(doc_id as text) modulo ``mod`` is not ``held``."""
    rows = docs.select(crc_mod("doc_id", mod).alias("r"), F.col("lang").cast("string").alias("lang"), text_of().alias("text"),
                       F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(1 << 20)).alias("deal"))
    usable = rows.filter((F.col("r") != held) & F.col("lang").isNotNull() & (F.col("text") != ""))
    counts = {r["lang"]: r["n"] for r in usable.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}  # a row per language
    if not counts:
        return None
    rate = F.create_map(*[F.lit(x) for lang, n in counts.items() for x in (lang, min(1 << 20, -(-(SAMPLE_PER_LANG << 20) // n)))])
    ship(docs.sparkSession)
    dealt = usable.filter(F.col("deal") < rate[F.col("lang")]).select("lang", "text")
    sample = dealt.mapInArrow(_thinned, "lang string, text string")
    # a language's sample is bounded by SAMPLE_PER_LANG and SAMPLE_BYTES; its model is fitted where the sample is
    fitted = sorted(sample.groupBy("lang").applyInArrow(_fit_group(vocab), "lang string, probs binary").collect(), key=lambda r: r["lang"])
    return PieceModel(_vocabulary(vocab), [r["lang"] for r in fitted], np.stack([np.frombuffer(r["probs"]) for r in fitted], axis=1))


def predict(docs: DataFrame, model: PieceModel | None, vocab: str, text: str = "text") -> DataFrame:
    """``docs`` with ``__lang`` and ``__score`` of its column ``text``; none of its columns may begin with ``__``."""
    spark = docs.sparkSession
    if model is None:
        return docs.select("*", F.lit("und").alias("__lang"), F.lit(0.0).alias("__score"))
    ship(spark)
    # as large as the vocabulary times the languages, whatever the number of documents
    shared = spark.sparkContext.broadcast((model.langs, model.probs))
    # each text is sent once, unless it has to be cast
    place, cast = docs.columns.index(text), []
    if not isinstance(docs.schema[place].dataType, T.StringType):
        place, cast = len(docs.columns), [text_of(text).alias("__text")]
    rows = docs.select("*", *cast, text_of(text).rlike(LETTER).alias("__letter"))
    schema = T.StructType([*docs.schema.fields, T.StructField("__lang", T.StringType()), T.StructField("__score", T.DoubleType())])
    return rows.mapInArrow(_predict(shared, vocab, len(docs.columns), place), schema)


def identify(docs: DataFrame, vocab: str) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` of every row."""
    marked = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (crc_mod("doc_id", 3) == 1).alias("held_out"), "text")
    return predict(marked, train(docs, vocab), vocab).select(
        "doc_id", "held_out", F.col("__lang").alias("lang_pred"), F.col("__score").alias("score"))


def drop_unidentified(docs: DataFrame, vocab: str) -> DataFrame:
    """The rows of ``docs`` with a letter in their text, whether or not a model can be learnt; a null ``lang`` gets the
    predicted language.

    Repeated rows stay, an empty table gives no rows, and all columns are kept, whatever their names.
    """
    named, names = numbered(docs)
    own = {n: c for n, c in zip(docs.columns, names)}
    rows = named.select(*names, *[F.col(own[n]).alias(n) for n in ("doc_id", "text", "lang")])
    model = train(rows, vocab)
    kept = rows.filter(text_of().rlike(LETTER)) if model is None else predict(named, model, vocab, own["text"]).filter("__score > 0")
    lang = F.col(own["lang"]) if model is None else F.coalesce(own["lang"], F.col("__lang"))
    return kept.select(*[(lang if n == "lang" else F.col(c)).alias(n) for n, c in zip(docs.columns, names)])


def op9_segment_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return identify(documents(spark, sf_dir), public_tokenizers.path("piece_bpe_32k.model"))
