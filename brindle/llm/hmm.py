"""A hidden Markov language model, trained by Baum-Welch over a whole corpus, beside a smoothed unigram base.

Texts are cut into blocks of documents. A block is one row: its words once, in order of frequency, and its tokens as
numbers of them, so that a word costs a row a block and not a row a place. Word counts are summed over blocks and joined
back to them. A latent state emits classes of words (by hash, so that the model has the same size for any vocabulary) and
a class its words in proportion to their counts; both together are a distribution over token sequences. Each round of
training sums expected counts over all blocks as whole numbers, in any order the same; the driver sees the model only.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from brindle.llm import common

#: Latent states, classes of words (the end has one of its own behind them), rounds of training.
STATES, CLASSES, ROUNDS = 8, 8192, 4
#: Bytes of text to a block, about; a longer text is a block of its own. Tokens that are worked on at once, about.
BLOCK, AT_ONCE = 16 << 20, 400_000
#: Tokens of a seed document at most: they set where training starts.
SEED_TOKENS = 20_000
#: Probability of staying in a state before training; weight of the class shares in a state's emissions; parts of one in
#: which expected counts are summed.
STAY, PRIOR, UNIT = 0.8, 200.0, 1 << 20
END = ""  # no word is empty

_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def held_out(id_col: str = "doc_id"):
    """crc32 of the id as text leaves 2 when divided by 7; a null id is not held out."""
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(7)) == 2, F.lit(False))


def class_of(word: str | bytes) -> int:
    return CLASSES if word in (END, b"") else zlib.crc32(word.encode() if isinstance(word, str) else word) % CLASSES


# Blocks


def _block(ids: list, held: list[bool], texts: list[bytes]) -> tuple:
    """One row of ``_BLOCKS`` but for the block's name."""
    tokens: list[bytes] = []
    lengths, seen = [], Counter()
    for t, out in zip(texts, held):
        w = t.translate(_LOWER).split()
        w.append(b"")
        lengths.append(len(w))
        tokens += w
        if not out:
            seen.update(w)
    encoded = pa.array(tokens, pa.binary()).dictionary_encode()
    numbers, words = encoded.indices.to_numpy(), encoded.dictionary.to_pylist()
    order = np.argsort(-np.bincount(numbers, minlength=len(words)), kind="stable")
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    numbers = place[numbers]
    words = [words[k] for k in order]
    low, high = (numbers & 0xFFFF).astype("<u2").tobytes(), (numbers >> 16).astype("<u2").tobytes()
    classes = np.array([class_of(w) for w in words], "<u2").tobytes()
    return ids, held, lengths, low, high, classes, words, [seen.get(w, 0) for w in words]


def blocks(df: DataFrame, text_col: str = "text", id_col: str = "doc_id", size: int = BLOCK) -> DataFrame:
    """Written as Parquet: a row for each block: its ids, held-out flags and token counts, its tokens as numbers of words
    (low and high 16 bits), the words' classes, and the words with their counts in what is not held out."""
    rows = df.select(F.col(id_col).alias("doc_id"), held_out(id_col).alias("held_out"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    kind = rows.schema["doc_id"].dataType
    schema = T.StructType([T.StructField("ids", T.ArrayType(kind)), T.StructField("held", T.ArrayType(T.BooleanType())), T.StructField("lengths", T.ArrayType(T.LongType())), *(T.StructField(n, T.BinaryType()) for n in ("low", "high", "classes")), T.StructField("words", T.ArrayType(T.BinaryType())), T.StructField("seen", T.ArrayType(T.LongType()))])
    common.bound_batches(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, held, texts, n = [], [], [], 0
        for batch in batches:
            for id_, out, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).cast(pa.binary()).to_pylist()):
                if texts and n + len(text) > size:
                    yield common.batch(schema, [[v] for v in _block(ids, held, texts)])
                    ids, held, texts, n = [], [], [], 0
                ids.append(id_)
                held.append(out)
                texts.append(text)
                n += len(text)
        if texts:
            yield common.batch(schema, [[v] for v in _block(ids, held, texts)])
        common.trim()

    return common.staged(rows.mapInArrow(run, schema).withColumn("block", F.monotonically_increasing_id()), "hmm-blocks", {"parquet.page.size.row.check.min": "1"})  # rows of megabytes


def vocabulary(cut: DataFrame) -> DataFrame:
    """(word, n) of the words that training has, the end among them."""
    words = cut.select(F.explode(F.arrays_zip("words", "seen")).alias("w")).select("w.words", "w.seen").where("seen > 0")
    return common.staged(words.groupBy(F.col("words").alias("word")).agg(F.sum("seen").alias("n")), "hmm-vocabulary")


# The model


@dataclass
class Model:
    start: np.ndarray  # (states)
    move: np.ndarray  # (states, states)
    emit: np.ndarray  # (states, classes + 1)
    tokens: np.ndarray  # training tokens of each class
    words: np.ndarray  # distinct words of them

    def word_logs(self, counts: np.ndarray, classes: np.ndarray) -> np.ndarray:
        """log10 of a word's share in its class; a class keeps one part for words that training lacks, the end's none."""
        return np.log10((counts + 1) / (self.tokens + self.words + 1)[classes]) * (classes != CLASSES)


def class_shares(tokens: np.ndarray, words: np.ndarray) -> np.ndarray:
    weight = tokens + words + 1.0
    return weight / weight.sum()


def class_totals(known: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Training tokens and distinct words of each class; at most a row a class reaches the driver."""
    word = F.col("word")
    kind = F.when(F.length(word) == 0, F.lit(CLASSES)).otherwise(F.pmod(F.crc32(word), F.lit(CLASSES)).cast("int"))
    tokens, words = np.zeros(CLASSES + 1), np.zeros(CLASSES + 1)
    for r in known.groupBy(kind.alias("k")).agg(F.sum("n").alias("n"), F.count("*").alias("v")).collect():
        tokens[r["k"]], words[r["k"]] = r["n"], r["v"]
    return tokens, words


def start_model(tokens: np.ndarray, words: np.ndarray, seeds: list[np.ndarray], states: int) -> Model:
    """States that stay, and emit the class shares mixed with those of a seed document each."""
    shares = class_shares(tokens, words)
    emit = np.tile(shares, (states, 1))
    for k, seed in enumerate(seeds[:states]):
        own = np.bincount(seed, minlength=CLASSES + 1) + 0.0
        emit[k] = 0.5 * shares + 0.5 * own / own.sum()
    move = np.full((states, states), (1 - STAY) / max(1, states - 1))
    np.fill_diagonal(move, STAY if states > 1 else 1.0)
    return Model(np.full(states, 1 / states), move, emit, tokens, words)


def groups(lengths: np.ndarray, at_once: int = AT_ONCE) -> Iterator[np.ndarray]:
    """Sequences by falling length, about ``at_once`` tokens together."""
    order = np.argsort(-lengths, kind="stable")
    cuts = np.flatnonzero(np.diff(np.cumsum(lengths[order]) // at_once)) + 1
    yield from np.split(order, cuts)


def by_time(starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the tokens of sequences of falling lengths, all first ones, then all second ones; and how many each time has."""
    alive = np.searchsorted(-lengths, -np.arange(1, lengths[0] + 1), side="right")
    time = np.repeat(np.arange(lengths[0]), alive)
    sequence = np.arange(len(time)) - np.repeat(np.cumsum(alive) - alive, alive)
    return starts[sequence] + time, alive


def forward(model: Model, classes: np.ndarray, alive: np.ndarray, keep: bool = False) -> tuple[np.ndarray, np.ndarray | None, np.ndarray | None]:
    """(log10 likelihood of each sequence; scaled forward values and scales of all tokens, if kept), by time."""
    emitted = model.emit.T[classes]
    logs = np.zeros(alive[0])
    values = np.empty_like(emitted) if keep else None
    scales = np.empty(len(classes))
    at, before = 0, None
    for n in alive:
        now = emitted[at : at + n] * (model.start if before is None else before[:n] @ model.move)
        scale = now.sum(1)
        now /= scale[:, None]
        scales[at : at + n] = scale
        if keep:
            values[at : at + n] = now
        before = now
        at += n
    log_scales, at = np.log10(scales), 0
    for n in alive:
        logs[:n] += log_scales[at : at + n]
        at += n
    return logs, values, scales


def expected(model: Model, classes: np.ndarray, alive: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Expected starts, moves and emissions (Baum-Welch) of the sequences."""
    _, values, scales = forward(model, classes, alive, keep=True)
    emitted = model.emit.T[classes] / scales[:, None]
    states, ends = len(model.start), np.cumsum(alive)
    back = np.ones((alive[0], states))
    moves = np.zeros((states, states))
    for t in range(len(alive) - 1, -1, -1):
        at, n = ends[t] - alive[t], alive[t]
        if t:
            ahead = emitted[at : at + n] * back[:n]
            prior = ends[t - 1] - alive[t - 1]
            moves += values[prior : prior + n].T @ ahead
            values[at : at + n] *= back[:n]
            back[:n] = ahead @ model.move.T
        else:
            values[at : at + n] *= back[:n]
    emissions = np.stack([np.bincount(classes, values[:, k], CLASSES + 1) for k in range(states)])
    return values[: alive[0]].sum(0), moves * model.move, emissions


def tokens_of(low: bytes, high: bytes) -> np.ndarray:
    return np.frombuffer(low, "<u2").astype(np.int64) | np.frombuffer(high, "<u2").astype(np.int64) << 16


def trained(model: Model, cut: DataFrame) -> Model:
    """A round of Baum-Welch over all blocks."""
    states = len(model.start)
    width = CLASSES + 1
    schema = T.StructType([T.StructField("at", T.IntegerType()), T.StructField("n", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(states + states * states + states * width, np.int64)
        for batch in batches:
            for held, lengths, low, high, classes in zip(*(batch.column(k).to_pylist() for k in range(5))):
                sequence = np.frombuffer(classes, "<u2")[tokens_of(low, high)]
                lengths = np.array(lengths)
                starts = np.cumsum(lengths) - lengths
                mine = np.flatnonzero(~np.array(held))
                for some in groups(lengths[mine]) if len(mine) else ():
                    places, alive = by_time(starts[mine[some]], lengths[mine[some]])
                    found = expected(model, sequence[places], alive)
                    sums += np.rint(np.concatenate([x.ravel() for x in found]) * UNIT).astype(np.int64)
        at = np.flatnonzero(sums)
        if len(at):
            yield common.batch(schema, [pa.array(at.astype(np.int32)), pa.array(sums[at])])
        common.trim()

    parts = cut.select("held", "lengths", "low", "high", "classes").mapInArrow(run, schema)
    sums = np.zeros(states + states * states + states * width)
    found = parts.groupBy("at").agg(F.sum(F.col("n").cast("decimal(38,0)")).alias("n")).select("at", F.col("n").cast("double").alias("n")).toArrow()  # as many rows as the model has numbers
    sums[found["at"].to_numpy()] = found["n"].to_numpy() / UNIT
    start, move, emit = sums[:states], sums[states : states + states * states].reshape(states, states), sums[states + states * states :].reshape(states, width)
    emit = emit + PRIOR * class_shares(model.tokens, model.words)
    return Model((start + 1) / (start + 1).sum(), (move + 1) / (move + 1).sum(1, keepdims=True), emit / emit.sum(1, keepdims=True), model.tokens, model.words)


def seeds(cut: DataFrame, states: int = STATES) -> list[np.ndarray]:
    """Classes of ``states`` documents' tokens, at most ``SEED_TOKENS`` of each: of the longest ones of each block that are
    not held out, those first by a hash. So many reach the driver, whatever the corpus."""
    schema = T.StructType([T.StructField("k", T.LongType()), T.StructField("classes", T.BinaryType())])

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        out: list[bytes] = []
        for held, lengths, low, high, classes in zip(*(batch.column(k).to_pylist() for k in range(5))):
            sequence, lengths = np.frombuffer(classes, "<u2")[tokens_of(low, high)], np.array(lengths)
            starts = np.cumsum(lengths) - lengths
            longest = [k for k in np.argsort(-lengths, kind="stable") if not held[k]][:states]
            out += [sequence[starts[k] : starts[k] + min(lengths[k], SEED_TOKENS)].tobytes() for k in longest]
        return common.batch(schema, [[zlib.crc32(x) for x in out], out])

    found = common.map_batches(cut.select("held", "lengths", "low", "high", "classes"), run, schema).distinct()
    return [np.frombuffer(r["classes"], "<u2") for r in found.orderBy("k", "classes").limit(states).collect()]


def fit(cut: DataFrame, known: DataFrame, states: int = STATES, rounds: int = ROUNDS) -> Model:
    """Trained on the documents that are not held out; without any, all classes are as likely."""
    tokens, words = class_totals(known)
    dealt = seeds(cut, states)
    model = start_model(tokens, words, dealt, states)
    for _ in range(rounds if dealt else 0):
        model = trained(model, cut)
    return model


# Scores


def scored(cut: DataFrame, known: DataFrame, model: Model) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of all documents of the blocks."""
    total, distinct = int(model.tokens.sum()), int(model.words.sum())
    words = cut.select(F.col("block").alias("owner"), F.posexplode("words").alias("at", "word"))
    # a word has a row a block at most; what a block gets back is as large as its own list of words
    counts = words.join(known, "word").select("owner", "at", "n")
    kind = cut.schema["ids"].dataType.elementType
    schema = T.StructType([T.StructField("doc_id", kind), T.StructField("held_out", T.BooleanType()), *(T.StructField(n, T.LongType()) for n in ("n_tokens", "n_known", "train_tokens")), T.StructField("base_score", T.DoubleType()), T.StructField("score", T.DoubleType())])

    def run(own: pa.Table, found: pa.Table) -> pa.Table:
        out = [pa.Table.from_batches([common.batch(schema, [[]] * len(schema))])]
        for row in own.to_pylist():
            classes, numbers, lengths = np.frombuffer(row["classes"], "<u2"), tokens_of(row["low"], row["high"]), np.array(row["lengths"])
            c = np.zeros(len(classes), np.int64)
            c[found["at"].to_numpy()] = found["n"].to_numpy()
            starts = np.cumsum(lengths) - lengths
            sums = lambda x: np.add.reduceat(x[numbers], starts)
            score, sequence = sums(model.word_logs(c, classes)), classes[numbers]
            for some in groups(lengths):
                places, alive = by_time(starts[some], lengths[some])
                score[some] += forward(model, sequence[places], alive)[0]
            base = sums(np.log10((c + 1) / (total + distinct + 1)))
            columns = [row["ids"], row["held"], pa.array(lengths), pa.array(sums((c > 0).astype(np.int64))), [total] * len(lengths), pa.array(base), pa.array(score)]
            out.append(pa.Table.from_batches([common.batch(schema, columns)]))
        common.trim()
        return pa.concat_tables(out)

    rows = cut.select("block", "ids", "held", "lengths", "low", "high", "classes")
    return rows.groupBy("block").cogroup(counts.groupBy("owner")).applyInArrow(run, schema)


def score(df: DataFrame, text_col: str = "text", id_col: str = "doc_id", states: int = STATES, rounds: int = ROUNDS) -> DataFrame:
    """Rows (doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score), one for each row.

    A null text is empty and has the end alone. A null id is not held out; repeated rows are rows of their own and count
    as often in training. Words are what lies between ASCII white space, A-Z lower-cased; whole texts are scored, a very
    long one in a block of its own, in time and memory as its length. Without rows there are none; where all documents are
    held out, all words are unknown. Extra columns are not looked at.
    """
    cut = blocks(df, text_col, id_col)
    known = vocabulary(cut)
    return scored(cut, known, fit(cut, known, states, rounds))
