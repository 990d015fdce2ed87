"""Language identification by word, with spans of mixed-language text.

A word's script narrows the candidate languages; its letters in context (each letter with its two neighbours)
give every candidate a log likelihood; Viterbi over the words, with a penalty for switching, labels spans.
The model counts letter contexts per language over all training texts, in a fixed number of hashed cells.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimloom.llm.common import fresh, lean, id_crc32, text_groups

CELLS = 1 << 15
SWITCH_PENALTY = 12.0
#: A language uses a script if at least this share of its training letters is written in it.
SCRIPT_SHARE = 0.01
#: What a word costs in a language whose texts do not use the word's script.
OTHER_SCRIPT = 30.0
UNDETERMINED = "und"
#: A document has a language if that holds at least this share of its letters.
MIN_SHARE = 0.35
_GROUP_CHARS = 2_000_000
_SEGMENT_CHARS = 1 << 19

#: The first code point of each script's range, up to the next one's.
SCRIPT_RANGES = (
    (0x0000, "Latin"),
    (0x0370, "Greek"),
    (0x0400, "Cyrillic"),
    (0x0530, "Armenian"),
    (0x0590, "Hebrew"),
    (0x0600, "Arabic"),
    (0x0900, "Devanagari"),
    (0x0980, "Bengali"),
    (0x0A00, "Gurmukhi"),
    (0x0A80, "Gujarati"),
    (0x0B80, "Tamil"),
    (0x0C00, "Telugu"),
    (0x0E00, "Thai"),
    (0x10A0, "Georgian"),
    (0x1100, "Hangul"),
    (0x1200, "Ethiopic"),
    (0x1E00, "Latin"),
    (0x1F00, "Greek"),
    (0x3040, "Kana"),
    (0x3100, "Han"),
    (0xAC00, "Hangul"),
    (0xF900, "Han"),
    (0xFB00, "Latin"),
    (0x10000, "Other"),
    (0x20000, "Han"),
)
SCRIPTS = tuple(dict.fromkeys(name for _, name in SCRIPT_RANGES))


class Letters:
    """Tables by code point, made from the interpreter's own: letter or not, lower case."""

    SIZE = 0x32400

    def __init__(self):
        points = [chr(i) if not 0xD800 <= i < 0xE000 else " " for i in range(self.SIZE)]
        self.letter = np.array([c.isalpha() for c in points])
        lower = [c.lower() for c in points]
        self.lower = np.array([ord(x) if len(x) == 1 else ord(c) for c, x in zip(points, lower, strict=True)], np.uint32)
        self.starts = np.array([start for start, _ in SCRIPT_RANGES])
        self.scripts = np.array([SCRIPTS.index(name) for _, name in SCRIPT_RANGES], np.int64)

    def words(self, text: str) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """Stretches of the text cut between words: offset, cells of letters, where words begin among
        them, word starts and ends in the stretch, and each word's script."""
        at = 0
        while at < len(text):
            end = min(len(text), at + _SEGMENT_CHARS)
            if end < len(text):
                cut = end
                while cut > at and text[cut - 1].isalpha():
                    cut -= 1
                end = cut if cut > at else end
            codes = np.frombuffer(text[at:end].encode("utf-32-le"), "<u4")
            codes = np.minimum(codes, self.SIZE - 1)
            inside = self.letter[codes]
            if inside.any():
                padded = np.full(len(codes) + 2, 32, np.uint32)
                padded[1:-1] = np.where(inside, self.lower[codes], 32)
                cells = padded[:-2] * np.uint32(0x9E3779B1)
                cells ^= padded[1:-1] * np.uint32(0x85EBCA77)
                cells += padded[2:] * np.uint32(0xC2B2AE3D)
                cells ^= cells >> np.uint32(15)
                cells *= np.uint32(0x2C1B3C6D)
                cells >>= np.uint32(17)
                edge = np.diff(inside.astype(np.int8), prepend=0, append=0)
                starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
                first = np.concatenate([[0], np.cumsum(ends - starts)[:-1]])
                script = self.scripts[np.searchsorted(self.starts, codes[starts], side="right") - 1]
                yield at, cells[inside].astype(np.int64), first, starts, ends, script
            at = end


@dataclass(frozen=True)
class Model:
    """``langs``, the log likelihood of each cell (cells x languages), and which scripts each language uses."""

    langs: tuple[str, ...]
    cells: np.ndarray
    allowed: np.ndarray


def train(docs: DataFrame, *, text: str = "text", lang: str = "lang") -> Model:
    """Counts of letter contexts and scripts per language, over every whole text with a language.

    Each task counts into a table of fixed size and sends its non-zero cells; the driver receives one
    row per language and cell. No texts, or none with a language: a model without languages.
    """
    source = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(
        F.col(lang).cast("string").alias("lang"), F.col(text).alias("text")
    )

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters = Letters()
        tables: dict[str, np.ndarray] = {}
        for part, texts in text_groups(batches, "text", _GROUP_CHARS):
            for name, one in zip(part.column("lang").to_pylist(), texts, strict=True):
                table = tables.setdefault(name, np.zeros(CELLS + len(SCRIPTS), np.int64))
                for _, cells, _, starts, ends, script in letters.words(one):
                    table[:CELLS] += np.bincount(cells, minlength=CELLS)
                    table[CELLS:] += np.bincount(script, weights=ends - starts, minlength=len(SCRIPTS)).astype(np.int64)
        for name, table in tables.items():
            used = np.flatnonzero(table)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(used), pa.string()), pa.array(used.astype(np.int32)), pa.array(table[used])],
                names=["lang", "cell", "n"],
            )

    counted = source.mapInArrow(lean(count), "lang string, cell int, n long").groupBy("lang", "cell").agg(F.sum("n").alias("n"))
    rows = counted.toArrow()
    names = rows.column("lang").to_numpy(zero_copy_only=False)
    langs = tuple(sorted(set(names)))
    totals = np.zeros((CELLS + len(SCRIPTS), len(langs)))
    totals[rows.column("cell").to_numpy(), np.searchsorted(np.array(langs, dtype=object), names)] = rows.column("n").to_numpy()
    seen, scripts = totals[:CELLS] + 0.1, totals[CELLS:]
    likelihood = np.log(seen / seen.sum(axis=0)).astype(np.float32)
    allowed = scripts >= SCRIPT_SHARE * np.maximum(scripts.sum(axis=0), 1)
    return Model(langs, likelihood, allowed)


def best_paths(scores: np.ndarray, sizes: np.ndarray, penalty: float) -> np.ndarray:
    """The best label of every word; ``scores`` holds the texts' words one after another, ``sizes`` words each.

    All texts advance together, longest first, so a step is one operation for as many texts as have that many words.
    """
    n, k = scores.shape
    labels = np.zeros(n, np.int16)
    if k < 2 or not n:
        return labels
    order = np.argsort(-sizes, kind="stable")
    begins = (np.cumsum(sizes) - sizes)[order]
    lengths = sizes[order]
    came = np.empty((n, k), np.int16)
    own = np.arange(k, dtype=np.int16)
    active = np.searchsorted(-lengths, -np.arange(1, lengths[0] + 1), side="right")
    delta = scores[begins[: active[0]]].copy()
    for step in range(1, lengths[0]):
        m = active[step]
        delta_m = delta[:m]
        best = delta_m.argmax(axis=1)
        top = delta_m[np.arange(m), best][:, None] - penalty
        stay = delta_m >= top
        at = begins[:m] + step
        came[at] = np.where(stay, own, best[:, None].astype(np.int16))
        delta[:m] = np.maximum(delta_m, top) + scores[at]
    state = delta.argmax(axis=1)
    # Backwards the texts join as their last word is reached.
    current = np.zeros(len(lengths), np.int64)
    current[: len(state)] = state
    for step in range(int(lengths[0]) - 1, -1, -1):
        m = active[step]
        at = begins[:m] + step
        labels[at] = current[:m]
        if step:
            current[:m] = came[at, current[:m]]
    return labels


def identify(
    docs: DataFrame,
    model: Model,
    *,
    text: str = "text",
    keep: tuple[str, ...] = ("doc_id",),
    penalty: float = SWITCH_PENALTY,
) -> DataFrame:
    """The ``keep`` columns, ``lang_pred``, ``score`` and the spans ``span_langs``, ``span_starts``, ``span_ends``.

    ``lang_pred`` holds most letters; ``score`` is its share of them times how sure the letters are of it against
    the next language. Null, empty and letterless texts are ``und`` with score 0 and no spans, as is any
    text if the model has no language. Ties go to the language first by code point. One pass, no shuffle; columns not in
    ``keep`` are not read.
    """
    read = fresh(docs, "langid_text")
    source = docs.select(*keep, F.col(text).alias(read))
    schema = docs.select(*keep).schema.add("lang_pred", "string").add("score", "double")
    schema = schema.add("span_langs", T.ArrayType(T.StringType()))
    for bounds in ("span_starts", "span_ends"):
        schema = schema.add(bounds, T.ArrayType(T.IntegerType()))
    # A fixed number of cells per language; plain arrays, which executors read without this package.
    shared = docs.sparkSession.sparkContext.broadcast((model.langs, model.cells, model.allowed))

    def label(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (langs, cell_scores, allowed), letters = shared.value, Letters()
        names = np.array([*langs, UNDETERMINED], dtype=object)
        k = len(langs)
        for part, texts in text_groups(batches, read, _GROUP_CHARS):
            scores, starts, ends, sizes = [], [], [], []
            for one in texts:
                n = 0
                for at, cells, first, begin, end, script in letters.words(one) if k else ():
                    found = np.add.reduceat(cell_scores[cells], first, axis=0)
                    usable = allowed[script]
                    usable |= ~usable.any(axis=1)[:, None]
                    scores.append(found - OTHER_SCRIPT * ~usable)
                    starts.append(begin + at)
                    ends.append(end + at)
                    n += len(begin)
                sizes.append(n)
            sizes = np.array(sizes, np.int64)
            pred, sure = np.full(len(texts), k), np.zeros(len(texts))
            span_langs = span_starts = span_ends = np.empty(0, np.int64)
            offsets = np.zeros(len(texts) + 1, np.int32)
            if sizes.sum():
                matrix, start, end = np.concatenate(scores), np.concatenate(starts), np.concatenate(ends)
                labels = best_paths(matrix, sizes, penalty).astype(np.int64)
                doc = np.repeat(np.arange(len(texts)), sizes)
                held = np.zeros((len(texts), k))
                np.add.at(held, (doc, labels), end - start)
                has = sizes > 0
                pred[has] = held[has].argmax(axis=1)
                share = held[has].max(axis=1) / held[has].sum(axis=1)
                totals = np.zeros((len(texts), k))
                np.add.at(totals, doc, matrix)
                # Per letter, so that the length of a text does not decide.
                odds = (totals[has] - totals[has, pred[has]][:, None]) / np.sqrt(held[has].sum(axis=1))[:, None]
                sure[has] = share / np.exp(np.minimum(odds, 50)).sum(axis=1)
                turn = np.flatnonzero((np.diff(doc, prepend=-1) != 0) | (np.diff(labels, prepend=-1) != 0))
                last = np.append(turn[1:] - 1, len(labels) - 1)
                span_langs, span_starts, span_ends = labels[turn], start[turn], end[last]
                offsets[1:] = np.cumsum(np.bincount(doc[turn], minlength=len(texts)))
            cuts = pa.array(offsets)
            yield pa.RecordBatch.from_arrays(
                [
                    *part.columns[: len(keep)],
                    pa.array(names[pred], pa.string()),
                    pa.array(np.clip(sure, 0.0, 1.0)),
                    pa.ListArray.from_arrays(cuts, pa.array(names[span_langs], pa.string())),
                    pa.ListArray.from_arrays(cuts, pa.array(span_starts.astype(np.int32))),
                    pa.ListArray.from_arrays(cuts, pa.array(span_ends.astype(np.int32))),
                ],
                names=schema.names,
            )

    return source.mapInArrow(lean(label), schema)


def held_out(doc_id: str = "doc_id", *, folds: int = 5, fold: int = 0) -> Column:
    """True for rows of the held-out fold; a null id is never held out."""
    return F.coalesce(id_crc32(doc_id) % folds == fold, F.lit(False))


def learn_and_identify(
    docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", keep: tuple[str, ...] | None = None
) -> DataFrame:
    """Train on the rows outside the held-out fold that have a language, then label every row."""
    model = train(docs.where(~held_out(doc_id)), text=text, lang=lang)
    return identify(docs, model, text=text, keep=(doc_id,) if keep is None else keep)


def with_letters(docs: DataFrame, *, text: str = "text") -> DataFrame:
    """The documents whose text has a letter, by the same table as ``identify``.

    Null and empty texts have none. Columns and repeated rows stay as they are; an empty table gives no rows.
    """

    def chosen(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters = Letters()
        for part, texts in text_groups(batches, text, _GROUP_CHARS):
            yield part.filter(pa.array([next(letters.words(one), None) is not None for one in texts], pa.bool_()))

    return docs.mapInArrow(lean(chosen), docs.schema)


def keep_identified(
    docs: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    languages: Sequence[str] | None = None,
    min_share: float = MIN_SHARE,
) -> DataFrame:
    """The documents whose language can be told, or is one of ``languages``; columns stay as they are.

    Rejected are texts without a letter (null, empty, digits and signs alone), and texts whose spans in the predicted
    language hold less than ``min_share`` of what all spans do: a jumble of languages. Text in two languages is kept.
    Where no text has a language to learn from, texts with a letter stay: nothing speaks against them. Repeated
    rows are judged each; an empty table gives no rows.
    """
    model = train(docs.where(~held_out(doc_id)), text=text, lang=lang)
    if not model.langs:
        return with_letters(docs, text=text)
    clear = {c: f"own_{i}" for i, c in enumerate(docs.columns)}
    labelled = identify(docs.withColumnsRenamed(clear), model, text=clear[text], keep=tuple(clear.values()))
    spans = F.arrays_zip("span_langs", "span_starts", "span_ends")
    whole = F.aggregate(spans, F.lit(0), lambda n, s: n + s["span_ends"] - s["span_starts"])
    in_own = F.filter(spans, lambda s: s["span_langs"] == F.col("lang_pred"))
    own = F.aggregate(in_own, F.lit(0), lambda n, s: n + s["span_ends"] - s["span_starts"])
    kept = labelled.where((F.col("lang_pred") != UNDETERMINED) & (own >= F.lit(min_share) * whole))
    if languages is not None:
        kept = kept.where(F.col("lang_pred").isin(list(languages)))
    return kept.select(*[F.col(own).alias(c) for c, own in clear.items()])
