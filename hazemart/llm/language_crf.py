"""Language of words and documents by a linear-chain conditional random field.

The states are languages. A word's features are its byte n-grams with the spaces around it (those
that touch a space are its affixes) and the word itself as a lexicon entry; all are hashed into
fixed tables. Transition weights are learned together with them from code-switched sequences, which
are cut and mixed from labelled documents. Marginals come from forward-backward over all words of a
text: segments of the chain are reduced to transfer matrices side by side, then joined, so that
numpy works on many words at once and a text may have any length.

Fitting reads a bounded sample (``SAMPLE_DOCS`` per language, each of at most ``SAMPLE_BYTES``).
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hazemart.llm import kernel

SAMPLE_DOCS = 200
SAMPLE_BYTES = 20_000
UNKNOWN = "und"
TABLE_BITS = 16
ORDERS = (2, 3, 4)
SEGMENT = 32
EPOCHS = 4
RATE = 0.5
RIDGE = 1e-6


@dataclass(frozen=True)
class Crf:
    """Weights: grams (orders, 2**bits, languages), lexicon (2**bits, languages), transitions and start."""

    languages: tuple[str, ...]
    grams: np.ndarray
    lexicon: np.ndarray
    transitions: np.ndarray
    start: np.ndarray


def features(column: pa.Array) -> tuple[list[np.ndarray], np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hashed n-grams at every byte of the words, the word edges among them, lexicon entries, rows.

    The last byte of a word's range is the separator after it.
    """
    body, offsets = kernel.text_bytes(column, lower=True)
    starts, ends, rows = kernel.words(body, offsets, kernel.LETTERISH)
    lengths = ends - starts + 1
    edges = np.cumsum(lengths) - lengths
    at = np.repeat(starts - edges, lengths) + np.arange(int(lengths.sum()))
    padded = np.append(body, np.uint8(32)).astype(np.uint32)
    now = padded[at]
    now[edges + lengths - 1] = 32
    # the bytes one, two and three back; a space before the word, nothing beyond it
    back = []
    for distance in range(1, max(ORDERS)):
        earlier = np.zeros_like(now)
        earlier[distance:] = now[:-distance]
        for k in range(distance):
            inside = edges[lengths > k] + k
            earlier[inside] = 32 if k == distance - 1 else 0
        back.append(earlier)
    gram, found = now, []
    for distance, earlier in enumerate(back, 1):
        gram = gram | (earlier << np.uint32(8 * distance))
        if distance == 1:
            found.append(gram)
        else:
            with np.errstate(over="ignore"):
                found.append((gram * np.uint32(2654435761)) >> np.uint32(32 - TABLE_BITS))
    lexicon = (kernel.word_hashes(body, starts, ends) >> np.uint64(64 - TABLE_BITS)).astype(np.int64)
    return found, edges, lexicon, rows, offsets


def emissions(model: Crf, found: list[np.ndarray], edges: np.ndarray, lexicon: np.ndarray) -> np.ndarray:
    if not len(edges):
        return np.zeros((0, len(model.languages)), np.float32)
    total = model.grams[0][found[0]]
    for weights, index in zip(model.grams[1:], found[1:], strict=True):
        total += weights[index]
    return np.add.reduceat(total, edges, axis=0) + model.lexicon[lexicon]


def marginals(scores: np.ndarray, rows: np.ndarray, transitions: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Probability of every state at every word, and the vector each word's forward message had before it."""
    n, k = scores.shape
    if not n:
        return np.zeros((0, k)), np.zeros((0, k))
    potential = np.exp(scores.astype(np.float64) - scores.max(axis=1, keepdims=True))
    step = np.exp(transitions - transitions.max())
    first = np.empty(n, bool)
    first[0], first[1:] = True, rows[1:] != rows[:-1]
    chain_start = np.flatnonzero(first)
    chain_length = np.diff([*chain_start, n])
    # segments of at most SEGMENT words; the longest first, so those still running are a prefix
    pieces = -(-chain_length // SEGMENT)
    chain_of = np.repeat(np.arange(len(pieces)), pieces)
    number = np.arange(len(chain_of)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    begin = chain_start[chain_of] + number * SEGMENT
    size = np.minimum(SEGMENT, chain_start[chain_of] + chain_length[chain_of] - begin)
    order = np.argsort(-size, kind="stable")
    begin_by, size_by = begin[order], size[order]
    running = [int(np.searchsorted(-size_by, -t, side="left")) for t in range(SEGMENT)]  # size > t

    head = np.cumsum(pieces) - pieces
    heads_by = np.flatnonzero(number[order] == 0)
    opening = np.exp(start - start.max())

    def transfer() -> np.ndarray:
        product = np.broadcast_to(step, (len(order), k, k)).copy()
        product[heads_by] = np.diag(opening)  # a chain's first word takes the start weights in place of a transition
        for t in range(SEGMENT):
            if not (live := running[t]):
                break
            moved = (product[:live] @ step if t else product[:live]) * potential[begin_by[:live] + t][:, None, :]
            product[:live] = moved / moved.max(axis=(1, 2), keepdims=True)
        out = np.empty_like(product)
        out[order] = product
        return out

    whole = transfer()
    # messages into each segment, chain by chain; chains with most segments first
    alpha_in, beta_in = np.ones((len(begin), k)), np.ones((len(begin), k))
    by_pieces = np.argsort(-pieces, kind="stable")
    longest = int(pieces.max())
    live_at = [by_pieces[: int(np.searchsorted(-pieces[by_pieces], -p, side="left"))] for p in range(longest)]  # pieces > p
    for p in range(1, longest):
        at = head[live_at[p]] + p
        message = np.einsum("ni,nij->nj", alpha_in[at - 1], whole[at - 1])
        alpha_in[at] = message / message.max(axis=1, keepdims=True)
    for p in range(longest - 2, -1, -1):
        at = head[live_at[p + 1]] + p
        message = np.einsum("nij,nj->ni", whole[at + 1], beta_in[at + 1])
        beta_in[at] = message / message.max(axis=1, keepdims=True)
    alpha, before = np.empty((n, k)), np.empty((n, k))
    message = alpha_in[order]
    for t in range(SEGMENT):
        if not (live := running[t]):
            break
        at = begin_by[:live] + t
        before[at] = message[:live]
        moved = message[:live] @ step
        if not t:
            moved[heads_by] = opening
        moved = np.maximum(moved, 1e-300) * potential[at]
        message[:live] = moved / moved.max(axis=1, keepdims=True)
        alpha[at] = message[:live]
    beta = np.empty((n, k))
    message = beta_in[order]
    for t in range(SEGMENT - 1, -1, -1):
        if not (live := running[t]):
            continue
        at = begin_by[:live] + t
        beta[at] = message[:live]
        moved = (potential[at] * message[:live]) @ step.T
        message[:live] = moved / moved.max(axis=1, keepdims=True)
    joint = alpha * beta
    return joint / joint.sum(axis=1, keepdims=True), before


def fit(texts: list[str], labels: list[str], seed: int = 11) -> Crf:
    """Weights from labelled texts by stochastic gradient on the likelihood of mixed sequences."""
    languages = tuple(sorted(set(labels)))
    k, size = len(languages), 1 << TABLE_BITS
    state = {name: i for i, name in enumerate(languages)}
    grams, lexicon = np.zeros((len(ORDERS), size, k), np.float32), np.zeros((size, k), np.float32)
    transitions, start = np.zeros((k, k)), np.zeros(k)
    model = Crf(languages, grams, lexicon, transitions, start)
    if k < 2:
        return model
    random = np.random.default_rng(seed)
    cuts = []
    for text, label in zip(texts, labels, strict=True):
        parts, at = text.split(" "), 0
        while at < len(parts):
            length = int(random.integers(8, 80))
            cuts.append((" ".join(parts[at : at + length]), state[label]))
            at += length
    squares = [np.full_like(x, 1e-3) for x in (grams, lexicon, transitions, start)]

    def descend(weights: np.ndarray, square: np.ndarray, slope: np.ndarray) -> None:
        square += slope * slope
        weights -= RATE * slope / np.sqrt(square)

    for _ in range(EPOCHS):
        random.shuffle(cuts)
        for low in range(0, len(cuts), 400):
            part = cuts[low : low + 400]
            found, edges, lex, rows, _ = features(pa.array([text for text, _ in part]))
            if not len(edges):
                continue
            truth = np.array([label for _, label in part])[rows]
            chain = rows // 5  # five cuts follow each other in one sequence
            scores = emissions(model, found, edges, lex)
            belief, before = marginals(scores, chain, transitions, start)
            error = belief.copy()
            error[np.arange(len(truth)), truth] -= 1.0
            error /= len(truth)
            spread = np.repeat(error, np.diff([*edges, len(found[0])]), axis=0)
            for g, index in enumerate(found):
                slope = np.stack([np.bincount(index, spread[:, j], size) for j in range(k)], axis=1) + RIDGE * grams[g]
                descend(grams[g], squares[0][g], slope)
            descend(lexicon, squares[1], np.stack([np.bincount(lex, error[:, j], size) for j in range(k)], axis=1) + RIDGE * lexicon)
            follows = np.flatnonzero(chain[1:] == chain[:-1]) + 1
            step = np.exp(transitions - transitions.max())
            arrive = belief[follows] / np.maximum(before[follows] @ step, 1e-300)
            pairs = before[follows][:, :, None] * step[None] * arrive[:, None, :]
            slope = pairs.sum(axis=0)
            np.subtract.at(slope, (truth[follows - 1], truth[follows]), 1.0)
            descend(transitions, squares[2], slope / len(truth))
            heads = np.flatnonzero(np.r_[True, chain[1:] != chain[:-1]])
            descend(start, squares[3], error[heads].sum(axis=0))
    return model


def labelled_sample(docs: DataFrame, keep: Column, text_col: str, lang_col: str) -> tuple[list[str], list[str]]:
    """At most ``SAMPLE_DOCS`` texts per language, those with the smallest hashes."""
    usable = docs.where(keep & F.col(lang_col).isNotNull() & (F.octet_length(text_col) <= SAMPLE_BYTES) & (F.length(text_col) > 0))
    ranked = usable.select(F.col(text_col).alias("_text"), F.col(lang_col).alias("_lang"), F.xxhash64(text_col).alias("_hash"))
    window = Window.partitionBy("_lang").orderBy("_hash", "_text")
    taken = ranked.withColumn("_n", F.row_number().over(window)).where(F.col("_n") <= SAMPLE_DOCS)
    rows = taken.select("_text", "_lang").orderBy("_lang", "_n").collect()
    return [r[0] for r in rows], [r[1] for r in rows]


def fit_documents(docs: DataFrame, keep: Column | None = None, text_col: str = "text", lang_col: str = "lang") -> Crf:
    return fit(*labelled_sample(docs, F.lit(True) if keep is None else keep, text_col, lang_col))


def _predicted(model: Crf, column: pa.Array) -> tuple[list[str], np.ndarray]:
    found, edges, lexicon, rows, offsets = features(column)
    count = len(offsets) - 1
    sums = np.zeros((count, max(1, len(model.languages))))
    n_words = np.bincount(rows, minlength=count)
    if len(model.languages) and len(rows):
        belief, _ = marginals(emissions(model, found, edges, lexicon), rows, model.transitions, model.start)
        heads = np.flatnonzero(np.r_[True, rows[1:] != rows[:-1]])
        sums[rows[heads]] = np.add.reduceat(belief, heads, axis=0)
    best = sums.argmax(axis=1)
    score = sums[np.arange(count), best] / np.maximum(n_words, 1)
    names = [model.languages[b] if n and model.languages else UNKNOWN for b, n in zip(best, n_words, strict=True)]
    # few words need the slow look: those without an ASCII letter
    if count:
        plain = pc.fill_null(pc.match_substring_regex(column, "[A-Za-z]"), False).to_numpy(zero_copy_only=False)
        for i in np.flatnonzero(~plain & (n_words > 0)):
            if not any(c.isalpha() for c in column[int(i)].as_py()):
                names[i] = UNKNOWN
    score = np.where([name == UNKNOWN for name in names], 0.0, np.clip(score, 0.0, 1.0))
    return names, score


def predict(docs: DataFrame, model: Crf, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, lang_pred and score (mean probability of that language over all words).

    ``und`` with score 0 where the text is null or has no letter, or where nothing was learned.
    Ties go to the language that sorts first. Only id and text are read; equal texts give equal
    results, null ids are carried along, an empty table gives no rows. Nothing is shuffled.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # fixed size: tables of 2**TABLE_BITS rows
    schema = T.StructType([
        T.StructField(id_col, docs.schema[id_col].dataType), T.StructField("lang_pred", T.StringType()),
        T.StructField("score", T.DoubleType()),
    ])

    def label(batch: pa.RecordBatch) -> pa.RecordBatch:
        names, score = _predicted(shared.value, batch.column("_text"))
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(names, pa.string()), pa.array(score)], names=schema.names)

    return kernel.arrow_map(docs.select(F.col(id_col), F.col(text_col).alias("_text")), label, schema, "_text", 1 << 18)


def word_languages(model: Crf, text: str) -> list[tuple[str, str, float]]:
    """(word, language, probability) for each word of one text."""
    column = pa.array([text])
    found, edges, lexicon, rows, _ = features(column)
    belief, _ = marginals(emissions(model, found, edges, lexicon), rows, model.transitions, model.start)
    body, offsets = kernel.text_bytes(column, lower=True)
    starts, ends, _ = kernel.words(body, offsets, kernel.LETTERISH)
    spans = [bytes(body[a:b]).decode("utf-8") for a, b in zip(starts, ends, strict=True)]
    return [(w, model.languages[b.argmax()], float(b.max())) for w, b in zip(spans, belief, strict=True)]


def recognised(docs: DataFrame, model: Crf, min_score: float, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, with all their columns, whose text has a language with ``min_score`` or more."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def keep(batch: pa.RecordBatch) -> pa.RecordBatch:
        names, score = _predicted(shared.value, batch.column(text_col))
        return batch.filter(pa.array((np.array(names, object) != UNKNOWN) & (score >= min_score)))

    return kernel.arrow_map(docs, keep, docs.schema, text_col, 1 << 18)
