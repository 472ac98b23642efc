"""Byte-pair segmentation of whole corpora.

Merging symbols is a loop per word that column expressions cannot state, so it runs on Arrow batches, a block of
lines at a time: the block's words are dictionary-encoded, only the distinct ones are merged, all of them together
step by step, and lines pick their pieces by index. The job itself is narrow. Joining words back to their lines
instead would shuffle every word occurrence twice, and one frequent word would fill a task.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, functions as F, types as T

# Ship this module's functions with the job, so workers need no installed copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# End-of-word symbol, mark of non-final pieces, edge characters of a line, known versions.
END = "</w>"
SEPARATOR = "@@"
EDGE = "\r\n "
VERSIONS = ((0, 1), (0, 2))

# Bytes of lines segmented at once; one longer line is segmented alone.
BLOCK_BYTES = 2 << 20


@dataclass(frozen=True)
class Model:
    """Merge ranks plus the options of one encoder. Small, and sent to the workers."""

    ranks: dict[tuple[str, str], int]
    version: tuple[int, int] = (0, 1)
    vocab: frozenset[str] | None = None
    glossaries: tuple[str, ...] = ()
    separator: str = SEPARATOR
    # The pair each merged symbol came from, the best-ranked one if several give the same symbol.
    origins: dict[str, tuple[str, str]] = field(init=False, repr=False)

    def __post_init__(self) -> None:
        worst_first = sorted(self.ranks, key=self.ranks.__getitem__, reverse=True)
        object.__setattr__(self, "origins", {left + right: (left, right) for left, right in worst_first})


def _known_pieces(merges: DataFrame, vocab: DataFrame, separator: str) -> frozenset[str] | None:
    """Vocabulary entries that a merge can give: only these decide anything, so they are at most two per merge; None without entries.

    One job: null stands for all other entries, so that asking whether there are any costs no pass of its own.
    """
    symbol = F.concat("left", "right")
    forms = F.array(F.replace(symbol, F.lit(END), F.lit("")), F.concat(symbol, F.lit(separator)))
    made = merges.select(F.explode(forms).alias("token")).distinct().withColumn("known", F.col("token"))
    found = [r["known"] for r in vocab.select("token").join(made, "token", "left").select("known").distinct().collect()]
    return frozenset(token for token in found if token is not None) if found else None


def load_model(
    merges: DataFrame,
    version: tuple[int, int] = (0, 1),
    vocab: DataFrame | None = None,
    glossaries: Iterable[str] = (),
    separator: str = SEPARATOR,
) -> Model:
    """Collect ``rank, left, right`` merges, whose number is a setting of the model, and what a ``token`` vocabulary says of them.

    The vocabulary can be of any size and stays distributed; an empty one counts as none.
    """
    if tuple(version) not in VERSIONS:
        raise NotImplementedError(f"merges version {version}")
    ranks = {(m["left"], m["right"]): m["rank"] for m in merges.select("rank", "left", "right").collect()}
    known = None if vocab is None else _known_pieces(merges, vocab, separator)
    return Model(ranks, tuple(version), known, tuple(glossaries), separator)


def _ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The numbers of each range ``start, start + 1, ...`` one after another."""
    before = np.cumsum(lengths) - lengths
    return np.repeat(starts - before, lengths) + np.arange(int(lengths.sum()))


class Segmenter:
    """Segments many words at once: symbols are integers, and a step joins the best-ranked pair of every word that has one."""

    # What a symbol is in its word, as bits: the last of a stretch, followed by a separator, not held against the vocabulary,
    # written as it is.
    FINAL, SEPARATED, ANY, PLAIN = 1, 2, 4, 8
    BITS = 4

    def __init__(self, model: Model) -> None:
        self.model = model
        self.names = list(dict.fromkeys(chain.from_iterable((left, right, left + right) for left, right in model.ranks)))
        self.ids = {name: n for n, name in enumerate(self.names)}
        self.known = len(self.names)
        best_first = sorted(model.ranks, key=model.ranks.__getitem__)
        pairs = np.array([self.ids[left] * self.known + self.ids[right] for left, right in best_first], dtype=np.int64)
        self.joined = np.array([self.ids[left + right] for left, right in best_first], dtype=np.int64)
        self.never = len(best_first)
        self.order = np.argsort(pairs)
        self.pairs = pairs[self.order]
        self.glossaries = re.compile("|".join(f"(?:{term})" for term in model.glossaries)) if model.glossaries else None

    def _id(self, name: str, fresh: dict[str, int]) -> int:
        """Number of a symbol; ones the model does not know are numbered after its own."""
        known = self.ids.get(name)
        return fresh.setdefault(name, self.known + len(fresh)) if known is None else known

    def _stretches(self, words: list[str]) -> Iterator[tuple[int, str, bool]]:
        """Word number, text, and whether it is a match of a glossary pattern, which stays whole."""
        for n, word in enumerate(words):
            at = 0
            for match in self.glossaries.finditer(word) if self.glossaries else ():
                if match.end() > match.start():
                    if match.start() > at:
                        yield n, word[at : match.start()], False
                    yield n, match.group(), True
                    at = match.end()
            if at < len(word):
                yield n, word[at:], False

    def _symbols(self, texts: list[str], fresh: dict[str, int]) -> tuple[np.ndarray, np.ndarray]:
        """Symbols of each text before any is joined, and the number of the text each belongs to."""
        points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        owner = np.repeat(np.arange(len(texts)), np.fromiter(map(len, texts), np.int64, len(texts)))
        kinds, kind = np.unique(points, return_inverse=True)
        symbol = np.array([self._id(chr(c), fresh) for c in kinds], dtype=np.int64)[kind]
        last = np.append(owner[1:] != owner[:-1], True)[: len(owner)]
        if self.model.version == (0, 2):
            ends = {int(k): self._id(chr(kinds[k]) + END, fresh) for k in np.unique(kind[last])}
            symbol[last] = [ends[k] for k in kind[last].tolist()]
            return symbol, owner
        after = np.flatnonzero(last) + 1
        return np.insert(symbol, after, self._id(END, fresh)), np.insert(owner, after, owner[last])

    def _ranked(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Place of each pair among the merges, best first; ``never`` for pairs that are none."""
        out = np.full(len(left), self.never, dtype=np.int64)
        if not self.never:
            return out
        both = np.flatnonzero((left < self.known) & (right < self.known))
        wanted = left[both] * self.known + right[both]
        at = np.minimum(np.searchsorted(self.pairs, wanted), len(self.pairs) - 1)
        hit = self.pairs[at] == wanted
        out[both[hit]] = self.order[at[hit]]
        return out

    def _merge(self, symbol: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Join neighbours until no pair has a rank: of each text all occurrences of its best pair, from the left, in one step."""
        done: list[tuple[np.ndarray, np.ndarray]] = []
        rank = np.full(len(symbol), self.never, dtype=np.int64)
        inside = np.flatnonzero(owner[1:] == owner[:-1])
        rank[inside] = self._ranked(symbol[inside], symbol[inside + 1])
        while len(symbol):
            head = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
            size = np.diff(np.append(head, len(symbol)))
            best = np.repeat(np.minimum.reduceat(rank, head), size)
            open_ = best < self.never
            done.append((symbol[~open_], owner[~open_]))
            symbol, owner, rank, best = symbol[open_], owner[open_], rank[open_], best[open_]
            hit = np.flatnonzero(rank == best)
            # of overlapping occurrences every other one, from the first
            number = np.arange(len(hit))
            fresh = np.append(True, hit[1:] != hit[:-1] + 1)[: len(hit)]
            hit = hit[(number - np.maximum.accumulate(np.where(fresh, number, 0))) % 2 == 0]
            symbol[hit] = self.joined[best[hit]]
            keep = np.ones(len(symbol), dtype=bool)
            keep[hit + 1] = False
            changed = np.zeros(len(symbol), dtype=bool)
            changed[hit] = True
            symbol, owner, rank, changed = symbol[keep], owner[keep], rank[keep], changed[keep]
            again = np.flatnonzero(changed | np.append(changed[1:], False))
            rank[again] = self.never
            again = again[again + 1 < len(symbol)]
            again = again[owner[again] == owner[again + 1]]
            rank[again] = self._ranked(symbol[again], symbol[again + 1])
        symbol, owner = (np.concatenate([np.zeros(0, np.int64), *part]) for part in zip(*done)) if done else (symbol, owner)
        order = np.argsort(owner, kind="stable")
        return symbol[order], owner[order]

    def _written(self, name: str, kind: int) -> list[str]:
        """The pieces that a symbol becomes."""
        final = bool(kind & self.FINAL)
        piece = name.replace(END, "") if final and not kind & self.PLAIN else name
        pieces = [piece]
        if self.model.vocab is not None and not kind & self.ANY:
            pieces = _in_vocabulary(piece, final, self.model)
        out = [p + self.model.separator for p in pieces]
        return out if kind & self.SEPARATED or not final else [*out[:-1], pieces[-1]]

    def segment(self, words: list[str]) -> tuple[pa.Array, np.ndarray, np.ndarray]:
        """All pieces of the words in order; where those of each word start; and their number."""
        stretches = list(self._stretches(words))
        word = np.array([n for n, _, _ in stretches], dtype=np.int64)
        whole = np.array([w for _, _, w in stretches], dtype=bool)
        fresh: dict[str, int] = {}
        cut = np.flatnonzero(~whole)
        symbol, owner = self._symbols([stretches[i][1] for i in cut], fresh)
        alone = np.bincount(owner, minlength=len(cut))[owner] == 1
        single = np.zeros(len(cut), dtype=bool)
        single[owner[alone]] = True
        symbol, owner = self._merge(symbol, owner)
        last = np.append(owner[1:] != owner[:-1], True)[: len(owner)]
        kind = np.where(single[owner], self.ANY, 0)
        if self.model.version == (0, 1):
            stop = last & (symbol == self._id(END, fresh))
            before = np.append(stop[1:], False)[: len(stop)]
            kind[before] |= self.PLAIN
            last = (last | before)[~stop]
            symbol, owner, kind = symbol[~stop], owner[~stop], kind[~stop]
        stretch = cut[owner]
        # glossary matches are symbols that nothing changes
        kept = np.flatnonzero(whole)
        names = np.array([self._id(stretches[i][1], fresh) for i in kept], dtype=np.int64)
        place = np.searchsorted(stretch, kept)
        symbol, stretch = np.insert(symbol, place, names), np.insert(stretch, place, kept)
        kind, last = np.insert(kind, place, self.ANY | self.PLAIN), np.insert(last, place, True)
        more = np.append(word[1:] == word[:-1], False)[: len(word)]
        kind = kind | np.where(last, self.FINAL, 0) | np.where(last & more[stretch], self.SEPARATED, 0)
        codes, code = np.unique(symbol << self.BITS | kind, return_inverse=True)
        local = self.names + list(fresh)
        written = [self._written(local[c >> self.BITS], c & ((1 << self.BITS) - 1)) for c in codes.tolist()]
        length = np.fromiter(map(len, written), np.int64, len(written))
        first = np.cumsum(length) - length
        pieces = pa.array(list(chain.from_iterable(written)), pa.string())
        pieces = pieces.take(pa.array(_ranges(first[code], length[code])))
        number = np.bincount(word[stretch], weights=length[code], minlength=len(words)).astype(np.int64)
        return pieces, np.cumsum(number) - number, number

    def lines(self, texts: pa.Array) -> pa.ListArray:
        """Pieces of each line; null has none."""
        split = pc.split_pattern(pc.utf8_trim(pc.fill_null(texts, ""), EDGE), " ")
        words = split.flatten().dictionary_encode()
        pieces, first, number = self.segment(words.dictionary.to_pylist())
        used = words.indices.to_numpy(zero_copy_only=False)
        ends = np.append(0, np.cumsum(number[used]))
        offsets = split.offsets.to_numpy(zero_copy_only=False)
        found = pieces.take(pa.array(_ranges(first[used], number[used])))
        return pa.ListArray.from_arrays(pa.array(ends[offsets - offsets[0]], pa.int32()), found)


def _in_vocabulary(piece: str, final: bool, model: Model) -> list[str]:
    """Undo merges, from the last one down, in a piece the vocabulary does not know."""
    # The stack holds what is still to check, next piece on top.
    todo = [(piece, final)]
    out: list[str] = []
    while todo:
        piece, final = todo.pop()
        known = (piece if final else piece + model.separator) in model.vocab
        halves = None if known else model.origins.get(piece + END if final else piece)
        if halves is None:
            out.append(piece)
        else:
            left, right = halves
            todo += [(right[: -len(END)] if final else right, final), (left, False)]
    return out


def segment_word(word: str, model: Model) -> list[str]:
    """Pieces of one word, all but the last carrying the separator."""
    return Segmenter(model).segment([word])[0].to_pylist()


def _encoder(model: Model, limit: int) -> Callable[[Column], Column]:
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        segmenter = Segmenter(model)
        for lines in batches:
            size = np.cumsum(pc.fill_null(pc.binary_length(lines), 0).to_numpy(zero_copy_only=False).astype(np.int64))
            parts, at = [], 0
            while at < len(lines):
                before = int(size[at - 1]) if at else 0
                to = max(at + 1, int(np.searchsorted(size, before + limit, side="right")))
                parts.append(segmenter.lines(lines.slice(at, to - at)))
                at = to
            yield pa.concat_arrays(parts) if parts else pa.array([], pa.list_(pa.string()))
            # else a worker keeps what its largest batch took
            del lines, parts
            pa.default_memory_pool().release_unused()

    return F.arrow_udf(encode, T.ArrayType(T.StringType()))


def bpe_encode(df: DataFrame, model: Model, text: str = "text", out: str = "pieces") -> DataFrame:
    """Add ``out``, the subword pieces of each line (blank-separated words)."""
    return df.withColumn(out, _encoder(model, BLOCK_BYTES)(F.col(text)))


def bpe_encode_line(df: DataFrame, model: Model, text: str = "text", out: str = "encoded") -> DataFrame:
    """Add ``out``, the encoded line with the CR, LF and blanks at its edges kept."""
    edge = r"[\r\n ]*"
    head = F.regexp_extract(text, rf"\A{edge}", 0)
    tail = F.regexp_extract(text, rf"[^\r\n ]({edge})\z", 1)
    encoded = bpe_encode(df, model, text, "_pieces")
    return encoded.withColumn(out, F.concat(head, F.array_join("_pieces", " "), tail)).drop("_pieces")


def bpe_decode(pieces: Column) -> Column:
    """Text of a piece sequence."""
    return F.replace(F.array_join(pieces, " "), F.lit(SEPARATOR + " "), F.lit(""))


def sp_decode(pieces: Column) -> Column:
    """Text of word-boundary-marked pieces: one leading blank goes."""
    return F.regexp_replace(F.replace(F.array_join(pieces, ""), F.lit("▁"), F.lit(" ")), "^ ", F.lit(""))
