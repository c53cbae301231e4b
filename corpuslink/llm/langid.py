"""Language identification by cross-parsing: how few phrases of a language's text does a
document need?

For each language a suffix automaton of its training text is built; a document is cut
greedily into the longest phrases that occur in that text. Phrases are counted in
stretches of ``STRETCH`` letters and blanks (a phrase ends at a stretch's end, so a
document of any length is parsed in parallel and whole). Phrases times log2 of the
training length, over the document's length, estimates the cross entropy in bits a
character; the least wins, ties go to the first language by name.

Training takes whole documents of ``min_chars`` to ``max_chars`` characters in the order
of a hash of their id, up to ``train_chars`` characters a language: a bounded sample, so
that the automata fit in every task (about ``train_chars`` * 2 * classes * 4 bytes each).

Text: lower-cased letters, every run of other characters is one blank. Letters beyond the
``MAX_CLASSES`` commonest of the sample match nothing. A null text, or one without a
letter, is ``und`` with score 0; so is every text when no language was learned. Repeated
rows each get their answer; extra columns are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

STRETCH = 256
MAX_CLASSES = 200
PIECE_CHARS = 1 << 20          # longer documents are read in pieces of this length
LANES = 8192
BLANK, OTHER, PAD = 0, 1, 2    # character classes; letters follow


def letter_table() -> np.ndarray:
    """For each code point: OTHER for a letter, else BLANK."""
    return np.fromiter((OTHER if chr(i).isalpha() else BLANK for i in range(0x110000)),
                       np.uint8, 0x110000)


def class_codes(texts: list[str], table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(classes of all texts joined, length of each), runs of blanks made one."""
    low = [t.lower() for t in texts]
    ends = np.cumsum([len(t) for t in low], dtype=np.int64)
    codes = table[np.frombuffer("".join(low).encode("utf-32-le", "replace"), "<u4")]
    before = np.concatenate([[BLANK], codes[:-1]]) if len(codes) else codes
    starts = np.concatenate([[0], ends[:-1]])
    before[starts[starts < len(codes)]] = BLANK
    keep = (codes != BLANK) | (before != BLANK)
    total = np.concatenate([[0], np.cumsum(keep)])
    return codes[keep], total[ends] - total[starts]


def suffix_automaton(codes: list[int], classes: int) -> np.ndarray:
    """Transitions as one flat array: at state * classes + class the next state times
    ``classes``, 0 for none. State 1 is the root; PAD leads each state to itself."""
    link, length, step = [0, 0], [0, 0], [{}, {}]
    last = 1
    for c in codes:
        new = len(step)
        step.append({})
        length.append(length[last] + 1)
        link.append(1)
        p = last
        while p and c not in step[p]:
            step[p][c] = new
            p = link[p]
        if p:
            q = step[p][c]
            if length[q] == length[p] + 1:
                link[new] = q
            else:
                clone = len(step)
                step.append(dict(step[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p and step[p].get(c) == q:
                    step[p][c] = clone
                    p = link[p]
                link[q] = link[new] = clone
        last = new
    flat = np.zeros(len(step) * classes, np.int32)
    for s, out in enumerate(step):
        for c, to in out.items():
            flat[s * classes + c] = to * classes
    states = np.arange(len(step)) * classes
    flat[states + PAD] = states
    return flat


def count_phrases(stretches: np.ndarray, automaton: np.ndarray, classes: int) -> np.ndarray:
    """Phrases that each column of ``stretches`` (step x stretch) needs."""
    root = automaton[classes:2 * classes].copy()
    root[root == 0] = classes
    state = np.full(stretches.shape[1], classes, np.int32)
    phrases = np.ones(stretches.shape[1], np.int64)
    for row in stretches:
        new = automaton[state + row]
        missed = np.flatnonzero(new == 0)
        phrases[missed] += 1
        new[missed] = root[row[missed]]
        state = new
    return phrases


class Model:
    """The automata of all languages, small enough to send to every task."""

    def __init__(self, samples: dict[str, list[str]]):
        self.languages = sorted(samples)
        seen = Counter(c for texts in samples.values() for t in texts for c in t.lower()
                       if c.isalpha())
        self.letters = [c for c, _ in sorted(seen.items(), key=lambda x: (-x[1], x[0]))
                        ][:MAX_CLASSES]
        self.classes = 3 + len(self.letters)
        table = self.table()
        self.automata, self.bits = [], []
        for name in self.languages:
            codes, _ = class_codes([" ".join(samples[name])], table)
            self.automata.append(suffix_automaton(codes.tolist(), self.classes))
            self.bits.append(float(np.log2(max(2, len(codes)))))

    def table(self) -> np.ndarray:
        table = letter_table()
        for k, c in enumerate(self.letters):
            table[ord(c)] = 3 + k
        return table

    def phrases(self, texts: list[str], table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(document x language phrase counts, documents with a letter)."""
        owner, pieces = [], []
        for i, t in enumerate(texts):
            for k in range(0, len(t), PIECE_CHARS):
                owner.append(i)
                pieces.append(t[k:k + PIECE_CHARS])
        out = np.zeros((len(texts), len(self.languages)), np.int64)
        letters = np.zeros(len(texts), bool)
        if not pieces:
            return out, letters
        codes, sizes = class_codes(pieces, table)
        owner = np.array(owner)
        starts = np.cumsum(sizes) - sizes
        has = np.concatenate([[0], np.cumsum(codes != BLANK)])
        letters[owner[has[starts + sizes] > has[starts]]] = True
        number = -(-sizes // STRETCH)
        piece = np.repeat(np.arange(len(sizes)), number)
        nth = np.arange(len(piece)) - np.repeat(np.cumsum(number) - number, number)
        at = starts[piece] + nth * STRETCH
        left = sizes[piece] - nth * STRETCH
        doc = owner[piece]
        codes = np.concatenate([codes, np.full(STRETCH, PAD, np.uint8)])
        order = np.arange(STRETCH)
        for k in range(0, len(at), LANES):
            rows = codes[at[k:k + LANES, None] + order]
            rows[order >= left[k:k + LANES, None]] = PAD
            rows = np.ascontiguousarray(rows.T).astype(np.int32)
            for j, automaton in enumerate(self.automata):
                out[:, j] += np.bincount(doc[k:k + LANES], count_phrases(
                    rows, automaton, self.classes), len(texts)).astype(np.int64)
        return out, letters


def train(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
          lang_col: str = "lang", train_chars: int = 40_000, min_chars: int = 200,
          max_chars: int = 4_000) -> Model:
    """Learn from the non-null languages of ``docs`` (a bounded sample of each)."""
    size = F.length(text_col)
    rows = docs.where(F.col(lang_col).isNotNull() & size.between(min_chars, max_chars)).select(
        F.col(lang_col).alias("_lang"), F.col(text_col).alias("_text"),
        F.xxhash64(F.col(id_col).cast("string")).alias("_order"))
    first = Window.partitionBy("_lang").orderBy("_order", "_text")
    rows = rows.withColumn("_n", F.row_number().over(first)).where(
        F.col("_n") <= train_chars // min_chars)
    samples: dict[str, list[str]] = {}
    used: Counter = Counter()
    for lang, text, _, _ in sorted(rows.collect(), key=lambda r: (r[0], r[3])):
        if used[lang] + len(text) <= train_chars or lang not in samples:
            samples.setdefault(lang, []).append(text)
            used[lang] += len(text)
    return Model(samples)


def identify(docs: DataFrame, model: Model, *, id_col: str = "doc_id", text_col: str = "text",
             keep: dict[str, Column] | None = None) -> DataFrame:
    """(id_col, lang_pred, score, phrases by language) for every row.

    ``score`` is the winner's share of 2 ** -bits over the languages. ``keep`` names
    further columns to pass along.
    """
    from corpuslink.llm.tokens import slices
    held = docs.sparkSession.sparkContext.broadcast(model)
    keep = keep or {}

    def run(batches) -> Iterator[pa.RecordBatch]:
        model = held.value
        table = model.table()
        for batch in batches:
            for at, rows in slices(batch.column(0)):
                texts = [t or "" for t in batch.column(0).slice(at, rows).to_pylist()]
                found, letters = model.phrases(texts, table)
                names, scores = [], []
                if model.languages:
                    bits = found * np.array(model.bits)
                    least = bits.min(1)
                    best = bits.argmin(1)
                    share = 1 / np.exp2(np.maximum(least[:, None] - bits, -1000)).sum(1)
                    scores = np.where(letters, share, 0.0)
                    names = [model.languages[b] if ok else "und" for b, ok in zip(best, letters)]
                else:
                    names, scores = ["und"] * rows, [0.0] * rows
                yield pa.RecordBatch.from_arrays([
                    *(c.slice(at, rows) for c in batch.columns[1:]), pa.array(names, pa.string()),
                    pa.array(scores, pa.float64()), pa.array(found.tolist(),
                                                             pa.list_(pa.int64()))],
                    names=[*batch.schema.names[1:], "lang_pred", "score", "phrases"])

    rows = docs.select(F.col(text_col).alias("_text"), F.col(id_col).alias(id_col),
                       *(c.alias(k) for k, c in keep.items()))
    fields = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in rows.schema.fields[1:])
    return rows.mapInArrow(run, f"{fields}lang_pred string, score double, phrases array<long>")
