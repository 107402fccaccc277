"""Vectorised encoding of whole texts by a memo of short units.

Both tokenizers first split a text by ``public_tokenizers.PATTERN`` and then
merge bytes inside each match only. A text may therefore be cut wherever a
match surely ends, each distinct piece ("unit") encoded once, and the ids of
the pieces joined. Sure places, used here:

* before a single space, and around a single newline, with no white space next
  to it (a space belongs to the following match; a lone newline is its own);
* between an ASCII/Latin-1 letter or ASCII digit and a run of ASCII punctuation
  without apostrophe (which may begin a match with letters) that ends a word.

Texts with any other white-space neighbourhood are encoded whole.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from gridmix.llm.common import slices

# Unicode White_Space, as a character class without brackets
WHITE = r"\t-\r \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
# texts that the cuts above do not cover: white space at an end or in pairs, or our own mark
IRREGULAR = rf"^[{WHITE}]|[{WHITE}]\z|[{WHITE}][{WHITE}]|\x02"
PUNCTUATION = r"!-&(-/:-@\[-`{-~"  # of ASCII but the apostrophe, as a character class without brackets
WORD_END = rf"([0-9A-Za-zÀ-ÖØ-öø-ÿ])([{PUNCTUATION}]+)([ \n]|\z)"
MARK = "\x02"  # begins a unit that has no space before it

MAX_MEMO = 1 << 18  # units kept per Python worker
UNIT_BYTES = 2 << 20  # of text in work at once: its units take several times as much memory

Encode = Callable[[list[str]], list[bytes]]


class Memo:
    """Ids of at most MAX_MEMO units, so that a frequent one is encoded once.

    Frequent units come early: a full memo keeps what it has, and starts anew
    only when it misses more than half of the units of a call.
    """

    def __init__(self, encode: Encode):
        self.encode = encode
        self.known: dict[str, bytes] = {}

    def ids_of(self, units: list[str]) -> list[bytes]:
        known = self.known
        found = list(map(known.get, units))
        at = [i for i, ids in enumerate(found) if ids is None]
        if len(known) >= MAX_MEMO and 2 * len(at) > len(units):
            known.clear()
            at = range(len(units))
        missing = [units[i] for i in at]
        encoded = self.encode(missing)
        known.update(zip(missing[:MAX_MEMO - len(known)], encoded))
        for i, ids in zip(at, encoded):
            found[i] = ids
        return found


def unit(cut: str) -> str:
    """The unit of a piece between the spaces of a marked text."""
    return cut[1:] if cut[:1] == MARK else " " + cut if cut else ""


class UnitEncoder:
    """Encodes Arrow batches of texts; ids are little-endian unsigned 32-bit.

    ``encode_units`` gets distinct units (without white space but for a leading
    space, single inner white space, or a lone newline), ``encode_texts`` whole
    irregular texts; both return the ids of each as bytes.
    """

    def __init__(self, encode_units: Encode, encode_texts: Encode, whole: str = ""):
        """``whole``: pattern of further texts that are encoded whole."""
        self.encode_texts = encode_texts
        self.irregular = f"{IRREGULAR}|{whole}" if whole else IRREGULAR
        # by units as they are cut: only what the memo misses is put into shape
        self.memo = Memo(lambda cut: encode_units([unit(c) for c in cut]))

    def texts(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids, offsets): text i (null: empty) has ids[offsets[i]:offsets[i + 1]]."""
        texts = pc.fill_null(texts, "")
        n = len(texts)
        odd = pc.match_substring_regex(texts, self.irregular)
        marked = pc.replace_substring_regex(texts, WORD_END, rf"\1 {MARK}\2\3")
        marked = pc.replace_substring(marked, "\n", f" {MARK}\n {MARK}")
        marked = pc.binary_join_element_wise(MARK, marked, "")
        lists = pc.split_pattern(pc.if_else(odd, "", marked), " ")
        coded = lists.flatten().dictionary_encode()
        found = self.memo.ids_of(coded.dictionary.to_numpy(zero_copy_only=False).tolist())
        counts = lists.value_lengths().to_numpy()
        codes = coded.indices.to_numpy()
        lengths = np.fromiter(map(len, found), np.int64, len(found)) // 4
        starts = np.concatenate(([0], np.cumsum(lengths)))
        vocabulary = pa.ListArray.from_arrays(
            pa.array(starts, pa.int32()), pa.array(np.frombuffer(b"".join(found), "<u4")))
        ids = vocabulary.take(pa.array(codes)).flatten().to_numpy()
        ends = np.concatenate(([0], np.cumsum(lengths[codes])))
        offsets = ends[np.concatenate(([0], np.cumsum(counts)))]
        if not pc.any(odd).as_py():
            return ids, offsets
        # put the ids of whole irregular texts in their places
        at = np.flatnonzero(odd.to_numpy(zero_copy_only=False))
        alone = dict(zip(at.tolist(), self.encode_texts(texts.take(pa.array(at)).to_pylist())))
        parts = [np.frombuffer(alone[i], "<u4") if i in alone else ids[offsets[i]:offsets[i + 1]]
                 for i in range(n)]
        sizes = np.fromiter(map(len, parts), np.int64, n)
        return np.concatenate(parts), np.concatenate(([0], np.cumsum(sizes)))

    def batches(self, batch: pa.RecordBatch, text: str,
                ) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
        """(slice, ids, offsets) for the slices of a batch."""
        for part in slices(batch, text, UNIT_BYTES):
            yield part, *self.texts(part.column(text))
