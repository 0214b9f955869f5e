"""Token ids of whole texts inside Spark tasks.

A byte-level vocabulary with the usual pre-tokeniser never joins a token across a space that is followed by a visible
character, nor lets what stands before such a space change what follows.  Texts are cut there, every distinct piece is
encoded once for as long as the worker remembers it (in bounded memory, see ``KnownPieces``), and the ids of a text are those of its pieces one after the other.
The same holds between a letter and a punctuation mark and on either side of a lone line break between visible characters;
texts are cut there as well, by the bytes of all texts at once, so that a word is one piece whatever stands behind it.
``tests/llm`` compares this with the libraries' answers for whole texts.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text that are cut and looked up together, more only for one longer text.
GROUP = 2 << 20


class KnownPieces:
    """Ids of pieces as Arrow columns, looked up all at once; of more than ``most`` bytes those seen last are kept."""

    #: Bytes that an entry takes beside its piece and ids: offsets, when it was seen, its place in the table of a lookup.
    ENTRY = 100

    def __init__(self, most: int, dtype: np.dtype):
        self.most, self.now = most, 0
        self.pieces = pa.array([], pa.binary())
        self.ids = pa.array([], pa.list_(pa.from_numpy_dtype(dtype)))
        self.seen = np.zeros(0, np.int64)

    def look(self, pieces: pa.Array, learn) -> pa.Array:
        """The ids of distinct pieces as lists; ``learn`` gives those of the pieces that are not known."""
        places = pc.index_in(pieces, value_set=self.pieces).fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
        new = places < 0
        if new.any():
            unknown = pieces.filter(pa.array(new))
            places[new] = len(self.pieces) + np.arange(len(unknown))
            self.pieces = pa.concat_arrays([self.pieces, unknown])
            self.ids = pa.concat_arrays([self.ids, learn(unknown)])
            self.seen = np.concatenate((self.seen, np.zeros(len(unknown), np.int64)))
        self.now += 1
        self.seen[places] = self.now
        found = self.ids.take(pa.array(places))
        self._forget()
        return found

    def spell(self, pieces: pa.Array, learn) -> tuple[np.ndarray, np.ndarray]:
        """The ids of pieces, repeats among them, one after the other; where each piece begins, and the end of all."""
        coded = pieces.dictionary_encode()
        table = self.look(coded.dictionary, learn)
        ids = table.take(coded.indices).flatten().to_numpy(zero_copy_only=False)
        return ids, np.concatenate(([0], np.cumsum(_lengths(table)[coded.indices.to_numpy(zero_copy_only=False)])))

    def _forget(self) -> None:
        sizes = self.ENTRY + _lengths(self.pieces) + _lengths(self.ids) * self.ids.type.value_type.bit_width // 8
        if sizes.sum() <= self.most:
            return
        last_seen = np.lexsort((sizes, -self.seen))
        kept = np.sort(last_seen[np.cumsum(sizes[last_seen]) <= self.most // 2])
        self.pieces, self.ids, self.seen = self.pieces.take(pa.array(kept)), self.ids.take(pa.array(kept)), self.seen[kept]


def _lengths(values: pa.Array) -> np.ndarray:
    """Lengths of binary values or of lists, none of them null."""
    count = pc.list_value_length if pa.types.is_list(values.type) else pc.binary_length
    return count(values).to_numpy(zero_copy_only=False).astype(np.int64)


def _bytes(*spans: tuple[int, int]) -> np.ndarray:
    """Which byte values lie in one of the spans, both ends included."""
    table = np.zeros(256, bool)
    for first, last in spans:
        table[first : last + 1] = True
    return table


_LETTER = _bytes((0x41, 0x5A), (0x61, 0x7A))
_VISIBLE = _bytes((0x21, 0x7E))
_MARK = _VISIBLE & ~_LETTER & ~_bytes((0x30, 0x39))
#: First bytes of characters that are surely no white space: C2, E1, E2 and E3 begin some that are.
_NO_SPACE = _VISIBLE | _bytes((0xC3, 0xE0), (0xE4, 0xF4))
#: The character by which a byte-level vocabulary writes each byte.
_WRITTEN = np.arange(256, dtype="<u4")
_OTHER = ~(_VISIBLE | _bytes((0xA1, 0xAC), (0xAE, 0xFF)))
_WRITTEN[_OTHER] = 256 + np.arange(_OTHER.sum())


def _letters(data: np.ndarray) -> np.ndarray:
    """The bytes of ASCII letters, and the second bytes of the letters U+00C0 to U+00FF."""
    found = _LETTER[data]
    found[1:] |= (data[:-1] == 0xC3) & (data[1:] != 0x97) & (data[1:] != 0xB7)
    return found


def whole_words(pieces: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bytes of all binary pieces, their offsets, and which are letters up to U+00FF, with or without a space in front."""
    offsets = np.frombuffer(pieces.buffers()[1], np.int32)[pieces.offset : pieces.offset + len(pieces) + 1]
    data = np.frombuffer(pieces.buffers()[2] or b"", np.uint8)[: offsets[-1]]
    starts, stops = offsets[:-1], offsets[1:]
    letters = _letters(data)
    letters[:-1] |= (data[:-1] == 0xC3) & letters[1:]  # the first bytes of letters of two
    letters = np.concatenate(([0], np.cumsum(letters)))
    spaced = (stops > starts) & (data[np.minimum(starts, max(0, len(data) - 1))] == 0x20)
    return data, offsets, (stops - starts > spaced) & (letters[stops] - letters[starts] == stops - starts - spaced)


def cuts(data: np.ndarray, offsets: np.ndarray, spaces_only: bool = False) -> np.ndarray:
    """Where pieces begin in the UTF-8 bytes of texts that lie between ``offsets``, and the end of all."""
    cut = np.zeros(len(data) + 1, bool)
    if len(data):
        cut[: len(data) - 1] = (data[:-1] == 0x20) & _NO_SPACE[data[1:]]
    if len(data) and not spaces_only:
        visible = _VISIBLE[data]
        cut[1 : len(data)] |= _letters(data)[:-1] & _MARK[data[1:]]
        alone = (data[1:-1] == 0x0A) & visible[:-2] & visible[2:]
        cut[1 : len(data) - 1] |= alone
        cut[2 : len(data)] |= alone
    cut[offsets[1:] - 1] = False  # what follows a text's last byte is another text
    cut[offsets] = True
    return cut


class PieceEncoder:
    """Cuts texts, looks the pieces up and puts their ids together; subclasses know the ids of a piece."""

    #: Bytes for the pieces a worker remembers.
    remembered = 128 << 20
    #: So many times ``GROUP`` bytes are encoded together: a lookup goes over all known pieces once and should serve many.
    at_once = 8
    #: Texts with one of these strings are not cut.
    special: list[str] = []
    #: Whether texts are cut at spaces and nowhere else.
    spaces_only = False

    def __init__(self, dtype: np.dtype, share: int = 1) -> None:
        """``share``: the worker remembers so many times less."""
        self.dtype = dtype
        self.known = KnownPieces(self.remembered // share, dtype)

    def _learn(self, pieces: pa.Array) -> pa.Array:
        """The ids of each piece."""
        raise NotImplementedError

    def encode_groups(self, texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Group by group of texts: place of the first, all ids one text after the other, and the number of ids of each."""
        texts = texts.cast(pa.large_string()).fill_null("")
        ends, start = np.cumsum(_lengths(texts)), 0
        while start < len(texts):
            before = ends[start - 1] if start else 0
            end = max(start + 1, int(np.searchsorted(ends, before + GROUP * self.at_once, "right")))
            yield start, *self._encode_group(texts.slice(start, end - start))
            start = end

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts, one text after the other, and the number of ids of each; null counts as empty."""
        ids, counts = [np.zeros(0, self.dtype)], [np.zeros(0, np.int64)]
        for _, *some in self.encode_groups(texts):
            ids.append(some[0])
            counts.append(some[1])
        return np.concatenate(ids), np.concatenate(counts)

    def _encode_group(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
        data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
        offsets = offsets - offsets[0]
        cut = cuts(data, offsets, self.spaces_only)
        for content in self.special:
            for i in np.flatnonzero(pc.match_substring(texts, content).to_numpy(zero_copy_only=False)).tolist():
                cut[offsets[i] + 1 : offsets[i + 1]] = False
        bounds = np.flatnonzero(cut).astype(np.int32)
        pieces = pa.Array.from_buffers(pa.binary(), len(bounds) - 1, [None, pa.py_buffer(bounds), pa.py_buffer(data)])
        ids, begins = self.known.spell(pieces, self._learn)
        return ids, np.diff(begins[np.searchsorted(bounds, offsets)])


class Encoder(PieceEncoder):
    """Ids by a vocabulary file of the ``tokenizers`` library.

    Strings of special tokens in a text are ordinary text if ``special_as_text``, or else become the special ids, as the
    library has it unless told otherwise.
    """

    def __init__(self, path: str, special_as_text: bool = True):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, models, pre_tokenizers

        self.tokenizer = tool = Tokenizer.from_file(path)
        tool.encode_special_tokens = special_as_text
        added = tool.get_added_tokens_decoder().values()
        # White space before such a token belongs to no word after it: texts that hold one are not cut.
        self.special = [token.content for token in added if not (special_as_text and token.special)]
        super().__init__(np.dtype("<u2" if tool.get_vocab_size() <= 1 << 16 else "<u4"))
        # Whether a word of letters, written in the characters of the bytes, is what the pre-tokeniser hands to the model.
        before, self.model = tool.pre_tokenizer, tool.model
        self.by_words = (
            isinstance(self.model, models.BPE)
            and isinstance(before, pre_tokenizers.ByteLevel)
            and (before.use_regex, before.add_prefix_space, tool.normalizer, self.model.dropout) == (True, False, None, None)
        )

    def _learn(self, pieces: pa.Array) -> pa.Array:
        """The ids of each piece: of words by the library's model at once, of others by all of its steps."""
        found: list[list[int]] = [[]] * len(pieces)
        words = np.zeros(len(pieces), bool)
        if self.by_words:
            data, offsets, words = whole_words(pieces)
            starts, stops = offsets[:-1], offsets[1:]
            text = _WRITTEN[data].tobytes().decode("utf-32-le")
            split = self.model.tokenize
            places = np.flatnonzero(words)
            for i, start, stop in zip(places.tolist(), starts[places].tolist(), stops[places].tolist()):
                found[i] = [token.id for token in split(text[start:stop])]
        others = np.flatnonzero(~words)
        whole = pieces.take(pa.array(others)).cast(pa.string()).to_pylist()
        for i, encoding in zip(others.tolist(), self.tokenizer.encode_batch_fast(whole, add_special_tokens=False)):
            found[i] = encoding.ids
        bounds = np.concatenate(([0], np.cumsum(np.fromiter(map(len, found), np.int64, len(found)))))
        ids = np.fromiter(chain.from_iterable(found), self.dtype, int(bounds[-1]))
        return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids))


_encoders: dict[tuple[str, bool], Encoder] = {}


def encoder(path: str, special_as_text: bool = True) -> Encoder:
    """The worker's encoder for a vocabulary file; it lives as long as the worker."""
    key = path, special_as_text
    if key not in _encoders:
        _encoders[key] = Encoder(path, special_as_text)
    return _encoders[key]
