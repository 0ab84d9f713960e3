"""Language of each document and of each line of a mixed one, by a linear-chain conditional random field over its words.

A word's features are itself, its affixes, its character n-grams, its script and the languages whose lexicon holds it; the
transitions between neighbouring words are learned with them, by gradient ascent on the likelihood with forward-backward.
The field is fitted on a bounded sample of labelled documents (``Fit.per_label`` of each label); as labels are wrong here
and there and some documents mixed, the sample's lines are first relabelled by word counts, in a few rounds. All documents
are then labelled whole by forward-backward in one map over Arrow batches; the model is bounded by the sample and broadcast.
"""

from __future__ import annotations

import re
import unicodedata
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

LANGUAGES = ["en", "ar", "fr", "es", "tr", "fa", "ur"]
_WORD = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)*")
#: vowel marks, joiners and stretching are no part of a word
_UNWRITTEN = re.compile("[" + "".join(map(re.escape, [c for c in map(chr, range(0x3000)) if unicodedata.category(c) in ("Mn", "Cf")])) + "ـ]+")


@dataclass(frozen=True)
class Fit:
    """per_label: different labelled texts of each language that the field is fitted on, at most; most_chars: of such a text (longer ones are labelled, but not fitted on); rounds: of relabelling; epochs and rate: of the gradient; bits: of the feature hash; chunk: words of a training sequence."""

    per_label: int = 250
    most_chars: int = 20_000
    rounds: int = 4
    epochs: int = 8
    rate: float = 0.4
    bits: int = 16
    chunk: int = 80
    decay: float = 1e-6


def label_of(c: Column) -> Column:
    """The primary subtag of a label, trimmed, in lower case; null if it names none of the languages."""
    tag = F.split(F.lower(F.regexp_replace(c, r"(?U)^\s+|\s+$", "")), "[-_]", 2)[0]
    return F.when(tag.isin(LANGUAGES), tag)


def lines_of(text: str) -> list[str]:
    """The non-blank lines; a line ends with LF or CRLF."""
    return [x for x in text.split("\n") if x.strip()]


def words_of(line: str) -> list[str]:
    if not line.isascii():
        line = _UNWRITTEN.sub("", unicodedata.normalize("NFKC", line))
    return _WORD.findall(line.lower())


def features(word: str, lexicon: dict[str, tuple[int, ...]], bits: int) -> list[int]:
    """Hashed features of a word."""
    framed = f"^{word}$"
    out = {f"w{word}", "s" + unicodedata.name(word[0], "?").split(" ")[0]}
    for n in (1, 2, 3):
        out |= {f"p{word[:n]}", f"x{word[-n:]}"} | {framed[i : i + n] for i in range(len(framed) - n + 1)}
    held = lexicon.get(word)
    out |= {f"l{k}" for k in held} if held else {"l?"}
    mask = (1 << bits) - 1
    return [zlib.crc32(f.encode()) & mask for f in sorted(out)]


def forward_backward(e: np.ndarray, mask: np.ndarray, a: np.ndarray, start: np.ndarray, expect: bool = True) -> tuple[np.ndarray, np.ndarray | None]:
    """Posteriors (sequences x words x labels) and, if asked for, expected transitions. e: exp of emissions, a: exp of transitions; both scaled at each word."""
    b, t, k = e.shape
    fwd, bwd = np.empty_like(e), np.ones_like(e)
    row = e[:, 0] * start
    fwd[:, 0] = row = row / row.sum(1, keepdims=True)
    for i in range(1, t):
        new = (row @ a) * e[:, i]
        new /= new.sum(1, keepdims=True)
        row = np.where(mask[:, i, None], new, row)
        fwd[:, i] = row
    row = np.ones((b, k), e.dtype)
    for i in range(t - 2, -1, -1):
        new = (row * e[:, i + 1]) @ a.T
        new /= new.sum(1, keepdims=True)
        row = np.where(mask[:, i + 1, None], new, row)
        bwd[:, i] = row
    post = fwd * bwd
    post /= post.sum(2, keepdims=True)
    if not expect:
        return post, None
    ahead = e[:, 1:] * bwd[:, 1:] * mask[:, 1:, None]
    norm = np.einsum("btk,kl,btl->bt", fwd[:, :-1], a, ahead)
    ahead = ahead / np.where(norm > 0, norm, 1)[..., None]
    return post, a * np.einsum("btk,btl->kl", fwd[:, :-1], ahead)


class Field:
    """A fitted field: emission weights by feature, transitions, lexicon."""

    def __init__(self, weights: np.ndarray, trans: np.ndarray, start: np.ndarray, lexicon: dict[str, tuple[int, ...]], bits: int):
        self.weights, self.trans, self.start, self.lexicon, self.bits = weights, trans, start, lexicon, bits
        self._forget()

    def _forget(self) -> None:
        k = len(LANGUAGES)
        self.at: dict[str, int] = {}
        self.scores, self.held = np.zeros((1024, k)), np.zeros((1024, k), dtype=bool)

    def ids(self, words: list[str]) -> list[int]:
        """Rows of the words in ``scores`` (exp of emissions) and ``held`` (lexicons); new words get theirs now."""
        at = self.at
        for w in {w for w in words if w not in at}:
            i = self.at[w] = len(self.at)
            if i == len(self.scores):
                self.scores, self.held = np.concatenate([self.scores, np.zeros_like(self.scores)]), np.concatenate([self.held, np.zeros_like(self.held)])
            e = self.weights[features(w, self.lexicon, self.bits)].sum(0)
            self.scores[i] = np.exp(e - e.max())
            self.held[i, list(self.lexicon.get(w, ()))] = True
        return [at[w] for w in words]

    def posteriors(self, texts: list[list[int]]) -> list[np.ndarray]:
        """words x labels of each text of word ids, in groups of like length."""
        out: list[np.ndarray] = [np.zeros((0, len(LANGUAGES)))] * len(texts)
        order = sorted((i for i, t in enumerate(texts) if t), key=lambda i: len(texts[i]))
        a, start = np.exp(self.trans), np.exp(self.start)
        while order:
            n = max(1, min(256, 60_000 // len(texts[order[-1]])))
            group, order = order[-n:], order[:-n]
            longest = max(len(texts[i]) for i in group)
            x, mask = np.zeros((len(group), longest), dtype=np.int64), np.zeros((len(group), longest), dtype=bool)
            for r, i in enumerate(group):
                x[r, : len(texts[i])], mask[r, : len(texts[i])] = texts[i], True
            post = forward_backward(self.scores[x], mask, a, start, False)[0]
            for r, i in enumerate(group):
                out[i] = post[r, : len(texts[i])]
        return out


def relabel(sample: list[tuple[str, str]], rounds: int) -> list[list[tuple[list[str], int]]]:
    """Each document's lines as (words, label). Starts from the documents' labels; then word counts vote on each line, again and again."""
    docs = [[w for x in lines_of(text) if (w := words_of(x))] for text, _ in sample]
    labels = [[LANGUAGES.index(lang)] * len(lines) for lines, (_, lang) in zip(docs, sample)]
    k = len(LANGUAGES)
    for _ in range(rounds):
        counts: dict[str, np.ndarray] = {}
        for lines, own in zip(docs, labels):
            for ws, y in zip(lines, own):
                for w in ws:
                    counts.setdefault(w, np.zeros(k))[y] += 1
        total = sum(counts.values()) + 1.0
        # A word's share in each language; rare words say little.
        vote = {w: np.log((c / total * 1e6 + 1) / (c / total * 1e6 + 1).sum()) for w, c in counts.items()}
        labels = [[int(np.argmax(sum(vote[w] for w in ws))) for ws in lines] for lines in docs]
    return [list(zip(lines, own)) for lines, own in zip(docs, labels)]


def fit(sample: list[tuple[str, str]], how: Fit = Fit()) -> Field:
    """The field of a sample of (text, language)."""
    docs = relabel(sample, how.rounds)
    k = len(LANGUAGES)
    counts: Counter = Counter()
    for lines in docs:
        for ws, y in lines:
            counts.update((w, y) for w in ws)
    lexicon: dict[str, tuple[int, ...]] = {}
    for (w, y), n in sorted(counts.items()):
        if n >= 3 and n >= 0.1 * sum(counts[w, j] for j in range(k)):
            lexicon[w] = (*lexicon.get(w, ()), y)
    vocabulary = {w: i for i, w in enumerate(sorted({w for w, _ in counts}))}
    if not vocabulary:
        return Field(np.zeros((1 << how.bits, k), np.float32), np.zeros((k, k)), np.zeros(k), {}, how.bits)
    feats = [features(w, lexicon, how.bits) for w in vocabulary]
    flat, at = np.concatenate(feats), np.cumsum([0, *map(len, feats)])[:-1]
    sizes = np.array([len(f) for f in feats])
    chunks = []
    for lines in docs:
        ids = [vocabulary[w] for ws, _ in lines for w in ws]
        ys = [y for ws, y in lines for _ in ws]
        chunks += [(ids[i : i + how.chunk], ys[i : i + how.chunk]) for i in range(0, len(ids), how.chunk)]
    x, y, mask = (np.zeros((len(chunks), how.chunk), kind) for kind in (np.int64, np.int64, bool))
    for r, (ids, ys) in enumerate(chunks):
        x[r, : len(ids)], y[r, : len(ids)], mask[r, : len(ids)] = ids, ys, True
    rng = np.random.default_rng(0)
    w, trans, start = np.zeros((1 << how.bits, k)), np.eye(k), np.zeros(k)
    gw, gt, gs = np.full(w.shape, 1e-6), np.full((k, k), 1e-6), np.full(k, 1e-6)
    for _ in range(how.epochs):
        for rows in np.array_split(rng.permutation(len(chunks)), max(1, len(chunks) // 256)):
            bx, by, bm = x[rows], y[rows], mask[rows]
            table = np.add.reduceat(w[flat], at)
            e = table[bx]
            post, pairs = forward_backward(np.exp(e - e.max(2, keepdims=True)), bm, np.exp(trans), np.exp(start))
            truth = np.eye(k)[by]
            n = bm.sum()
            d = np.zeros((len(vocabulary), k))
            np.add.at(d, bx[bm], (truth - post)[bm])
            grad = np.zeros_like(w)
            np.add.at(grad, flat, np.repeat(d / n, sizes, axis=0))
            grad -= how.decay * w
            seen = np.zeros((k, k))
            both = bm[:, 1:]
            np.add.at(seen, (by[:, :-1][both], by[:, 1:][both]), 1)
            tgrad, sgrad = (seen - pairs) / n, (truth[:, 0] - post[:, 0]).sum(0) / n
            gw += grad**2
            gt += tgrad**2
            gs += sgrad**2
            w += how.rate * grad / np.sqrt(gw)
            trans += how.rate * tgrad / np.sqrt(gt)
            start += how.rate * sgrad / np.sqrt(gs)
    return Field(w.astype(np.float32), trans, start, lexicon, how.bits)


def sample_of(documents: DataFrame, how: Fit) -> list[tuple[str, str]]:
    """The bounded fitting sample: of each label the per_label different texts of at most most_chars characters that a hash of their content puts first.

    Labels are counted alone; of the hashes only those below a bound that the count sets (eight times what is asked for)
    are made distinct and ranked, so hardly anything is shuffled; a label that copies leave short is ranked in full.
    Texts are fetched last. The driver holds 7 x per_label texts, most_chars each at most.
    """
    spark = documents.sparkSession
    rows = documents.select(F.col("text").cast("string").alias("text"), label_of(F.col("lang").cast("string")).alias("label")).where("label is not null")
    counts = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count("*").alias("n")).collect()}
    salted = rows.where(F.col("text").rlike(r"\p{L}") & (F.length("text") <= how.most_chars)).withColumn("h", F.xxhash64("text"))

    def ranked(parts: dict[str, float]) -> list[tuple[str, int]]:
        """The first hashes of the labels, from the given parts of the range of hashes."""
        below = reduce(lambda x, y: x | y, ((F.col("label") == label) & (F.col("h") <= int(part * 2**64) - 2**63 - (part >= 1)) for label, part in parts.items()), F.lit(False))
        # Copies count once: the hashes are made distinct and ranked alone.
        hashes = salted.where(below).select("label", "h").distinct()
        first = hashes.withColumn("r", F.row_number().over(Window.partitionBy("label").orderBy("h"))).where(F.col("r") <= how.per_label)
        return [(r["label"], r["h"]) for r in first.select("label", "h").collect()]

    parts = {label: min(1.0, 8 * how.per_label / n) for label, n in counts.items()}
    first = ranked(parts)
    found = Counter(label for label, _ in first)
    short = {label: 1.0 for label, part in parts.items() if part < 1 and found[label] < how.per_label}
    if short:
        first = [x for x in first if x[0] not in short] + ranked(short)
    chosen = spark.createDataFrame(first, "label string, h bigint")
    texts = salted.join(F.broadcast(chosen), ["label", "h"]).distinct()  # per_label hashes of each label at most
    last = texts.withColumn("r", F.row_number().over(Window.partitionBy("label").orderBy("h", "text"))).where(F.col("r") <= how.per_label)
    return [(r["text"], r["label"]) for r in last.select("text", "label").orderBy("label", "text").collect()]


def judge(field: Field, texts: list[str | None]) -> list[tuple[str | None, float, list[tuple[str, float]], bool]]:
    """(main language, its confidence, (language, confidence) of each non-blank line, mixed) of each text; None for a text without a sentence."""
    if len(field.at) > 300_000:
        field._forget()
    raws = [lines_of(t) if t else [] for t in texts]
    split = [[words_of(x) for x in lines] for lines in raws]
    ids = [field.ids([w for ws in lines for w in ws]) for lines in split]
    out = []
    for raw, lines, own_ids, post in zip(raws, split, ids, field.posteriors(ids)):
        held, size = field.held[own_ids], np.array([len(w) for ws in lines for w in ws], dtype=float)
        # A sentence has three words in a row, on a line, that some lexicon holds, or three different ones of two letters or more.
        known, line = held.any(1), np.repeat(np.arange(len(lines)), [len(ws) for ws in lines])
        row = len(known) > 2 and (known[:-2] & known[1:-1] & known[2:] & (line[:-2] == line[2:])).any()
        if not row and len({i for i, k, n in zip(own_ids, known, size) if k and n > 1}) < 3:
            out.append((None, 0.0, [], False))
            continue
        weight, at, own = np.zeros(len(LANGUAGES)), 0, []
        for text, ws in zip(raw, lines):
            to = at + len(ws)
            mean = size[at:to] @ post[at:to] / size[at:to].sum() if ws else None
            best = int(mean.argmax()) if ws else -1
            if ws and held[at:to, best].sum() >= 2:
                weight[best] += len(text.strip())
                own.append((best, float(mean[best])))
            else:  # names, codes and fragments have no language of their own
                own.append(None)
            at = to
        if not weight.any():
            weight[int((size @ post).argmax())] = 1
        main = int(weight.argmax())
        sure = [c for x in own if x for b, c in [x] if b == main]
        named = [(LANGUAGES[x[0]], round(x[1], 4)) if x else (LANGUAGES[main], 0.0) for x in own]
        out.append((LANGUAGES[main], round(float(np.mean(sure)), 4) if sure else 0.0, named, bool((weight > 0).sum() > 1)))
    return out


def label_lines(documents: DataFrame, how: Fit = Fit()) -> DataFrame:
    """doc_id, line_no, lang, confidence, label, mixed: line_no 0 with the main language of each document that has a sentence, and each non-blank line from 1.

    label is the document's own label (primary subtag) or null. Null, empty and letterless texts and texts without a
    sentence give no rows; a line with fewer than two words of some lexicon takes the main language with confidence 0. Texts are read
    whole. Rows are kept as they come, a doc_id that comes twice twice.
    """
    field = documents.sparkSession.sparkContext.broadcast(fit(sample_of(documents, how), how))

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = field.value
        for batch in it:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                cols: list[list] = [[], [], [], [], [], []]
                for doc, label, (main, sure, lines, mixed) in zip(part.column(0).to_pylist(), part.column(2).to_pylist(), judge(own, part.column(1).to_pylist())):
                    if main is not None:
                        for row in [(doc, 0, main, sure, label, mixed), *((doc, i + 1, lang, c, label, mixed) for i, (lang, c) in enumerate(lines))]:
                            for col, v in zip(cols, row):
                                col.append(v)
                types = [pa.int64(), pa.int64(), pa.string(), pa.float64(), pa.string(), pa.bool_()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=["doc_id", "line_no", "lang", "confidence", "label", "mixed"])

    rows = documents.select("doc_id", F.col("text").cast("string").alias("text"), label_of(F.col("lang").cast("string")).alias("label"))
    return rows.mapInArrow(batches, "doc_id bigint, line_no bigint, lang string, confidence double, label string, mixed boolean")


def cases(labelled: DataFrame) -> DataFrame:
    """doc_id, line_no, lang of the documents whose label is missing, unknown or not the main language, or that are mixed; of lines only those of mixed documents. labelled: as label_lines gives it."""
    wrong = F.col("label").isNull() | (F.col("label") != F.col("lang"))
    return labelled.where(F.when(F.col("line_no") == 0, wrong | F.col("mixed")).otherwise(F.col("mixed"))).select("doc_id", "line_no", "lang")
