"""Language of a text by prediction by partial matching over bytes.

Per language a tree of byte contexts up to ``ORDER`` bytes is counted once and then frozen. A byte costs minus the
logarithm of its probability in the longest context that has been seen; where the context has never been
followed by that byte, the escape is paid and the next shorter context asked, down to all bytes being equally
likely. The language under which the whole text is shortest wins.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sportmart.llm.common import importable, staged

#: Bytes of the longest context; a context and its next byte fit an unsigned 32-bit number.
ORDER = 3
#: Labelled texts that the statistics are taken from, shared evenly by the languages, and the bytes that are taken of
#: each. So at most 12 MB are counted, whatever the input. The broadcast model has 6 bytes for every gram or context of two
#: to four bytes that a language has, 12 more for each distinct one, and 4 KB a language. Of more labels than texts, those
#: with most rows are learned.
TRAINING_TEXTS = 3000
TRAINING_BYTES = 4096
UNKNOWN = "und"
#: Share of training texts that may lie beyond a language's limit of bits per byte, and how many times theirs is allowed.
BEYOND = 0.01
ROOM = 1.25
#: Bits that any text may have beside that: one of a few bytes says little.
SPARE = 32
#: Bytes scored at a time.
BLOCK = 1 << 17
#: Texts scored at a time, and code lengths of single languages that are held beside them.
BLOCK_TEXTS = 512
EXPANDED = 1 << 17
#: What stands before a text: contexts at its start are those behind line breaks.
PAD = b"\n" * ORDER


def grams(raw: np.ndarray, ends: np.ndarray, order: int) -> np.ndarray:
    """The byte at each of ``ends`` and the ``order`` bytes before it, as one number."""
    out = np.zeros(len(ends), np.uint32)
    for back in range(order, -1, -1):
        out = (out << np.uint32(8)) | raw[ends - back]
    return out


def padded(texts: list[bytes], leads: list[bytes] | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All texts in one array, each behind a pad or its own of ``leads``; the places of their bytes and the texts that these
    belong to."""
    leads = leads or [PAD] * len(texts)
    raw = np.frombuffer(b"".join(x for pair in zip(leads, texts) for x in pair), np.uint8).astype(np.uint32)
    sizes = np.array([len(t) for t in texts], np.int64)
    text = np.repeat(np.arange(len(texts)), sizes)
    return raw, np.arange(len(text)) + (text + 1) * ORDER, text


class Sparse:
    """Per gram a number for each of the languages that have one; all others have zero."""

    def __init__(self, gram: np.ndarray, language: np.ndarray, value: np.ndarray):
        """Grams in ascending order."""
        self.keys, starts = np.unique(gram.astype(np.uint32), return_index=True)
        self.starts = np.append(starts, len(gram)).astype(np.int64)
        self.language = language.astype(np.uint16)
        self.value = value.astype(np.float32)

    def nbytes(self) -> int:
        return sum(x.nbytes for x in (self.keys, self.starts, self.language, self.value))

    def add(self, out: np.ndarray, text: np.ndarray, gram: np.ndarray, times: np.ndarray) -> None:
        """Add ``times`` the numbers of ``gram`` to the rows ``text`` (ascending) of ``out``, about ``EXPANDED`` at a time."""
        if not len(self.keys):
            return
        row = np.minimum(np.searchsorted(self.keys, gram), len(self.keys) - 1)
        hit = np.flatnonzero(self.keys[row] == gram)
        row, text, times = row[hit], text[hit], times[hit]
        first, sizes = self.starts[row], self.starts[row + 1] - self.starts[row]
        ends = np.cumsum(sizes)
        n, at, done = out.shape[1], 0, 0
        while at < len(row):
            cut = max(at + 1, int(np.searchsorted(ends, done + EXPANDED, "right")))
            size = sizes[at:cut]
            # Where the numbers of a row begin, less their places among all.
            entry = np.repeat(first[at:cut] - (ends[at:cut] - size), size) + np.arange(done, int(ends[cut - 1]))
            cell = np.repeat(text[at:cut] * n, size) + self.language[entry]
            weights = np.repeat(times[at:cut], size) * self.value[entry]
            # Texts stand in order, so only the lines of those at hand are touched.
            low, high = int(text[at]), int(text[cut - 1]) + 1
            out[low:high] += np.bincount(cell - low * n, weights, (high - low) * n).reshape(-1, n)
            at, done = cut, int(ends[cut - 1])


def coded(gram: np.ndarray, language: np.ndarray) -> np.ndarray:
    return (gram.astype(np.uint64) << np.uint64(16)) | language.astype(np.uint64)


def without_language(code: np.ndarray) -> np.ndarray:
    return (code >> np.uint64(16)).astype(np.uint32)


def before(gram: np.ndarray, order: int) -> np.ndarray:
    """The context of a gram."""
    return gram >> np.uint32(8) if order else gram * np.uint32(0)


class Model:
    """Frozen code lengths, in bits, of the counted contexts and bytes of every language.

    Only what a language has is stored. A gram that a language has is one that it has in every shorter order, so
    the code length of a byte is 8 bits, the escapes of all contexts known to the language, and, for each order in which it
    has the gram, its own length there less that order's escape and the length one order below.
    """

    def __init__(self, languages: list[str], counts: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]):
        """``counts``: by order the grams, the places of their languages and how often they occur."""
        self.languages = languages
        n = len(languages)
        #: Code lengths of single bytes, and the escapes after single bytes: 256 rows of all languages.
        self.single, self.after = np.full((256, n), 8.0), np.zeros((256, n))
        #: Numbers by gram, and by context, of the orders that single bytes do not cover.
        self.by_gram: dict[int, Sparse] = {}
        self.by_context: dict[int, Sparse] = {}
        #: Per order the grams with their languages, how often they occur, the contexts likewise, and their bytes and kinds of bytes.
        self.counted: list[tuple] | None = []
        #: Per language the bits per byte beyond which a text is in none; without any, every text is in one.
        self.limits: np.ndarray | None = None
        shorter = None
        for order in range(ORDER + 1):
            gram, language, times = counts[order]
            keys, row = np.unique(coded(gram, language), return_inverse=True)
            seen = np.bincount(row, times, len(keys))
            gram, language = without_language(keys), (keys & np.uint64(0xFFFF)).astype(np.int64)
            contexts, context = np.unique(coded(before(gram, order), language), return_inverse=True)
            total, kinds = np.bincount(context, seen), np.bincount(context)
            # Method C: as many escapes as kinds of bytes have followed. A context unknown to a language costs nothing.
            escape = np.log2((total + kinds) / kinds)
            own = np.log2((total + kinds)[context] / seen)
            known = (contexts & np.uint64(0xFFFF)).astype(np.int64)
            if order == 0:
                self.single[:, known] += escape
                self.single[gram, language] = own
            else:
                below = own - escape[context] - shorter[1][np.searchsorted(shorter[0], coded(self.suffix(gram, order), language))]
                self.by_gram[order] = Sparse(gram, language, below)
                if order == 1:
                    self.after[without_language(contexts), known] = escape
                else:
                    self.by_context[order] = Sparse(without_language(contexts), known, escape)
            self.counted.append((keys, seen, contexts, total, kinds))
            shorter = (keys, own)

    @staticmethod
    def suffix(gram: np.ndarray, order: int) -> np.ndarray:
        """The same byte in the context one order below."""
        return gram & np.uint32((1 << (8 * order)) - 1)

    def nbytes(self) -> int:
        """Size of what is broadcast once limits are known."""
        return self.single.nbytes + self.after.nbytes + sum(
            t.nbytes() for tables in (self.by_gram, self.by_context) for t in tables.values()
        )

    def bits(self, texts: list[bytes], leads: list[bytes] | None = None) -> np.ndarray:
        """Code length of each text under each language."""
        raw, at, text = padded(texts, leads)
        code, times = np.unique((text.astype(np.uint64) << np.uint64(32)) | grams(raw, at, ORDER), return_counts=True)
        text, gram = (code >> np.uint64(32)).astype(np.int64), code.astype(np.uint32)

        def per_byte(byte: np.ndarray) -> np.ndarray:
            return np.bincount(text * 256 + byte, times, len(texts) * 256).reshape(len(texts), 256)

        out = per_byte(gram & np.uint32(255)) @ self.single + per_byte((gram >> np.uint32(8)) & np.uint32(255)) @ self.after
        for order in range(1, ORDER + 1):
            own = self.suffix(gram, order + 1) if order < ORDER else gram
            self.by_gram[order].add(out, text, own, times)
            if order > 1:
                self.by_context[order].add(out, text, before(own, order), times)
        return out

    def long_bits(self, text: bytes) -> np.ndarray:
        """Code length of a text of any length, in blocks behind the bytes before them."""
        total = np.zeros(len(self.languages))
        behind = PAD + text
        for at in range(0, len(text), BLOCK):
            total += self.bits([text[at : at + BLOCK]], [behind[at : at + ORDER]])[0]
        return total

    def bits_left_out(self, language: int, text: bytes) -> float:
        """Code length of a counted text under its language, as if it had not been counted."""
        raw, at, _ = padded([text])
        shorter = None
        for order in range(ORDER + 1):
            keys, seen, contexts, total, kinds = self.counted[order]
            own, times = np.unique(grams(raw, at, order), return_counts=True)
            of_own = np.full(len(own), language)
            others = seen[np.searchsorted(keys, coded(own, of_own))] - times
            lead, context = np.unique(before(own, order), return_inverse=True)
            row = np.searchsorted(contexts, coded(lead, of_own[: len(lead)]))
            n = total[row] - np.bincount(context, times)
            k = kinds[row] - np.bincount(context, others == 0)
            with np.errstate(divide="ignore", invalid="ignore"):
                escape = np.where(n > 0, np.log2((n + k) / k), 0.0)
                cost = np.log2((n + k)[context] / others)
            if shorter is None:
                fallback = np.full(len(own), 8.0)
            else:
                fallback = shorter[1][np.searchsorted(shorter[0], self.suffix(own, order))]
            cost = np.where(others > 0, cost, escape[context] + fallback)
            shorter = (own, cost)
        return float((cost * times).sum())


def code_lengths(model: Model, texts: list[bytes]) -> np.ndarray:
    """Like ``Model.bits``, with bounded memory: a block of short texts at a time, long ones in parts."""
    out = np.zeros((len(texts), len(model.languages)))
    block, held = [], 0

    def flush() -> None:
        nonlocal held
        if block:
            out[block] = model.bits([texts[i] for i in block])
        block.clear()
        held = 0

    for i, text in enumerate(texts):
        if len(text) > BLOCK:
            out[i] = model.long_bits(text)
            continue
        block.append(i)
        held += len(text)
        if held >= BLOCK or len(block) >= BLOCK_TEXTS:
            flush()
    flush()
    return out


def held_out(id_column: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(id_column).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def training_rows(documents: DataFrame, id_column: str = "doc_id", text: str = "text", label: str = "lang") -> DataFrame:
    """``label`` and ``text`` of the documents that statistics are taken from.

    Learnable are rows with id, text and label outside the held-out quarter. Of each label those with the smallest
    digests are taken, as many as its even share of ``TRAINING_TEXTS``. Digests are spread evenly, so a bound on them
    leaves about four times the share of a frequent label to be ranked, whatever the input. Of a text longer than
    ``TRAINING_BYTES`` a stretch of so many bytes is taken, at a place that the digest says; ``text`` is binary.
    """
    rows = documents.select(F.col(id_column).alias("id"), F.col(text).alias("text"), F.col(label).alias("label"))
    rows = rows.where(F.col("id").isNotNull() & F.col("label").isNotNull() & ~held_out("id"))
    rows = rows.where(F.octet_length("text") > 0)
    rows = rows.withColumn("digest", F.xxhash64("id", "text"))
    slim = rows.select("id", "label", "digest")
    counts = rows.groupBy("label").agg(F.count(F.lit(1)).alias("n"))
    counts = counts.orderBy(F.desc("n"), "label").limit(TRAINING_TEXTS).collect()
    share = max(1, TRAINING_TEXTS // max(1, len(counts)))
    bounds = [(r["label"], min(2**63 - 1, 2**64 * 4 * share // r["n"] - 2**63)) for r in counts]
    bounds = rows.sparkSession.createDataFrame(bounds, "label string, bound long")
    # One row per language.
    slim = slim.join(F.broadcast(bounds), "label").where("digest <= bound").select("label", "digest", "id").distinct()
    order = Window.partitionBy("label").orderBy("digest", "id")
    chosen = slim.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= share)
    # At most TRAINING_TEXTS rows. Repeated rows count once.
    taken = rows.join(F.broadcast(chosen.select("label", "digest", "id")), ["label", "digest", "id"])
    beyond = F.greatest(F.octet_length("text") - TRAINING_BYTES, F.lit(0))
    start = F.pmod("digest", (beyond + 1).cast("long")).cast("int") + 1
    stretch = F.substring(F.col("text").cast("binary"), start, F.lit(TRAINING_BYTES)).alias("text")
    return taken.select("label", "digest", "id", stretch).dropDuplicates(["label", "digest", "id"]).select("label", "text")


def whole_characters(stretch: bytes) -> bytes:
    """Without the parts of characters at the ends of a stretch."""
    return stretch.decode("utf-8", "ignore").encode()


def count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of every order per label, summed over the batch."""
    for batch in batches:
        labels = np.array(batch.column(0).to_pylist(), dtype=object)
        texts = [whole_characters(t) for t in batch.column(1).to_pylist()]
        for label in sorted(set(labels)):
            raw, at, _ = padded([t for t, own in zip(texts, labels) if own == label])
            for order in range(ORDER + 1):
                keys, times = np.unique(grams(raw, at, order), return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([label] * len(keys), pa.string()), pa.array([order] * len(keys), pa.int32()),
                        pa.array(keys.astype(np.int64)), pa.array(times, pa.int64()),
                    ],
                    ["label", "order", "gram", "n"],
                )


def fit(documents: DataFrame, limited: bool = False, **columns: str) -> Model | None:
    """The model of the labelled rows; nothing if there are none. ``limited``: with limits of bits per byte."""
    importable(documents.sparkSession)
    rows = training_rows(documents, **columns)
    if limited:
        rows = staged(documents.sparkSession, rows, "training")
    counted = rows.mapInArrow(count_grams, "label string, `order` int, gram long, n long")
    summed = counted.groupBy("label", "order", "gram").agg(F.sum("n").alias("n")).toArrow()
    if not summed.num_rows:
        return None
    languages = sorted(pc.unique(summed["label"]).to_pylist())
    language = pc.index_in(summed["label"], pa.array(languages)).to_numpy()
    of_order, gram, n = (summed[c].to_numpy() for c in ("order", "gram", "n"))
    counts = {}
    for order in range(ORDER + 1):
        own = of_order == order
        counts[order] = (gram[own].astype(np.uint32), language[own], n[own].astype(np.float64))
    model = Model(languages, counts)
    if limited:
        model.limits = limits_of(rows, model)
    # Only limits need the counts.
    model.counted = None
    return model


def limits_of(rows: DataFrame, model: Model) -> np.ndarray:
    """Per language the bits per byte that all but ``BEYOND`` of the training texts that it wins stay within, and
    ``ROOM`` times that. A text is scored under its label by the statistics of the others; another language wins it
    where the label is wrong. One number per training text comes to the driver."""
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def left_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted = shared.value
        for batch in batches:
            labels = [fitted.languages.index(label) for label in batch.column(0).to_pylist()]
            texts = [whole_characters(t) for t in batch.column(1).to_pylist()]
            bits = code_lengths(fitted, texts)
            for i, (own, text) in enumerate(zip(labels, texts)):
                bits[i, own] = fitted.bits_left_out(own, text) if text else 0.0
            rates = bits.min(axis=1) / np.maximum(1, [len(t) for t in texts])
            yield pa.RecordBatch.from_arrays(
                [pa.array(bits.argmin(axis=1).astype(np.int64)), pa.array(rates, pa.float64())], ["language", "rate"]
            )

    told = rows.mapInArrow(left_out, "language long, rate double").toPandas()
    rates = told.groupby("language")["rate"].quantile(1 - BEYOND, interpolation="higher")
    # A language that wins none of the texts has the widest limit.
    return ROOM * rates.reindex(range(len(model.languages))).fillna(rates.max()).to_numpy()


def language_of(documents: DataFrame, model: Model | None):
    """A column function ``text -> struct<lang: string, score: double>``.

    ``score`` is the winner's share if all languages were equally likely before; ties go to the first by name. A text that
    is null, or has no letter, or any text without a model, is ``und`` with score 0; so is one beyond the limit of the
    winner's bits per byte, if the model has limits.
    """
    spark = documents.sparkSession
    importable(spark)
    shared = spark.sparkContext.broadcast(model)

    @F.arrow_udf("struct<lang: string, score: double>")
    def predict(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        fitted = shared.value
        for batch in batches:
            texts = batch.to_pylist()
            lang, score = [UNKNOWN] * len(texts), [0.0] * len(texts)
            asked = [i for i, t in enumerate(texts) if t and any(map(str.isalpha, t))] if fitted else []
            if asked:
                raw = [texts[i].encode("utf-8", "replace") for i in asked]
                bits = code_lengths(fitted, raw)
                best = bits.argmin(axis=1)
                share = 1 / np.exp2(bits.min(axis=1, keepdims=True) - bits).sum(axis=1)
                fits = np.ones(len(asked), bool)
                if fitted.limits is not None:
                    fits = bits.min(axis=1) <= fitted.limits[best] * [len(t) for t in raw] + SPARE
                for k, i in enumerate(asked):
                    if not fits[k]:
                        continue
                    lang[i], score[i] = fitted.languages[best[k]], float(share[k])
            yield pa.StructArray.from_arrays([pa.array(lang, pa.string()), pa.array(score, pa.float64())], ["lang", "score"])

    return predict


def identified(documents: DataFrame) -> DataFrame:
    """Per document the predicted language. Repeated rows get equal predictions; empty tables give an empty result."""
    predict = language_of(documents, fit(documents))
    rows = documents.select("doc_id", held_out().alias("held_out"), predict("text").alias("p"))
    return rows.select("doc_id", "held_out", F.col("p.lang").alias("lang_pred"), F.col("p.score").alias("score"))
