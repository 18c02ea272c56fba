"""Token ids of whole texts by a public tokenizer, with the pieces met before remembered.

Both tokenizers used here cut a text where white space begins, at the last of it before a word, and between a letter or digit and
marks after it, so a text's ids are those of its pieces one after the other. A piece is what lies between two cuts in the bytes of
a slice of texts: numpy finds the cuts, Arrow finds equal pieces, and the ids of all pieces are gathered at once.

The library encodes the pieces that are new. A word of plain Latin letters is one word to both tokenizers, so the library's model of
the same file takes it as it is; every other piece passes the whole tokenizer, put apart by a token that the library
never joins with anything. A text with the string of a special token is encoded by the library as a whole, so that the
string gives that token, or, with ``special_as_text``, like any other text.
"""

from __future__ import annotations

import os
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_SPACED = re.compile(r"\s")
#: White space of more than one byte.
_WIDE_SPACES = [0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
_WIDE_SPACES = np.array([int.from_bytes(chr(c).encode()) for c in _WIDE_SPACES])
#: Words of Latin letters (U+0130 is two characters in lower case), with the blank before them.
_WORD = re.compile(rb" ?(?:[A-Za-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf]|\xc4[\x80-\xaf\xb1-\xbf]|[\xc5-\xc8][\x80-\xbf])+")
#: Two-byte characters in the range of these letters that are none, and U+0130.
_NO_LETTERS = [0xC397, 0xC3B7, 0xC4B0]
#: Pieces that one worker remembers, about, and the bytes of the longest of them.
REMEMBERED = 1_000_000
_LONGEST = 48
#: Marks that end a word.
_MARKS = b".,!?;:#%"
_BLANKS = b"\t\n\x0b\x0c\r "
#: Pieces joined to one text, and texts encoded by one call.
_TOGETHER = 500
_CALL = 64
END_ID = 2

_SPACE, _MARK, _LETTER = 1, 2, 3
_KINDS = np.zeros(256, np.uint8)
_KINDS[list(_BLANKS)] = _SPACE
_KINDS[list(_MARKS)] = _MARK
_KINDS[[b for b in range(128) if chr(b).isalnum()]] = _LETTER
#: First bytes of characters that are surely no white space.
_NO_SPACE = np.array([_KINDS[b] != _SPACE and not 0x80 <= b <= 0xC2 and b not in (0xE1, 0xE2, 0xE3) for b in range(256)])
#: Bytes with A-Z in lower case and a blank for white space.
_LOWERED = np.frombuffer(bytes(range(256)).lower().translate(bytes.maketrans(_BLANKS, b" " * len(_BLANKS))), np.uint8)


def _characters() -> np.ndarray:
    """The characters that stand for bytes in a byte-level model; the line's end stays, as it puts words apart."""
    others = [b for b in range(256) if not (0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or 0xAE <= b)]
    out = np.arange(256, dtype="<u4")
    out[others] = np.arange(256, 256 + len(others))
    out[0x0A] = 0x0A
    return out


_CHARACTERS = _characters()


def _bytes_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts and where each begins, the end of the last one too."""
    bounds = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, np.uint8)[bounds[0] : bounds[-1]] if raw is not None and raw.size else np.zeros(0, np.uint8)
    return data, bounds - bounds[0]


def _lowered(data: np.ndarray) -> np.ndarray:
    """A-Z in lower case and blanks for white space, but not before a character that may combine with what is before it."""
    out = _LOWERED[data]
    before = np.flatnonzero(data[1:] >= 0xCC)  # U+0300 and above
    out[before] = data[before]
    return out


def _last_two(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    return data[at - 2].astype(np.int64) << 8 | data[at - 1]


def _cuts(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Where pieces begin: at each text, at each run of white space, at and after its last character, and at marks after a letter or digit.

    Both tokenizers cut at the last character of a run before a word; it stays with the word if it is a blank. A text that ends in a run is not cut there.
    """
    kinds = _KINDS[data]
    cut = np.zeros(len(data) + 1, bool)
    cut[starts] = True
    space = kinds == _SPACE
    last = np.flatnonzero(space[:-1] & _NO_SPACE[data[1:]])
    last = last[~cut[last + 1]]
    runs = np.flatnonzero(space[1:] & ~space[:-1]) + 1
    high = data[runs - 1] >= 0x80  # may be the end of white space
    two = _last_two(data, runs[high])
    high[high] = np.isin(two, _WIDE_SPACES) | np.isin(data[runs[high] - 3].astype(np.int64) << 16 | two, _WIDE_SPACES)
    marks = np.flatnonzero((kinds[1:] == _MARK) & (kinds[:-1] != _MARK)) + 1
    wide = marks[data[marks - 1] >= 0x80]
    two = _last_two(data, wide)
    cut[last] = True
    cut[last[data[last] != 0x20] + 1] = True
    cut[runs[~high]] = True
    cut[marks[kinds[marks - 1] == _LETTER]] = True
    cut[wide[(two >= 0xC380) & (two <= 0xC8BF) & ~np.isin(two, _NO_LETTERS)]] = True
    return np.flatnonzero(cut[: len(data)])


class Encoder:
    """Encodes texts to unsigned 32-bit ids, ``END_ID`` last."""

    def __init__(self, name: str, folder: str | None = None, special_as_text: bool = False) -> None:
        import public_tokenizers
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import CharDelimiterSplit

        self.tokenizer = Tokenizer.from_file(os.path.join(folder, name) if folder else public_tokenizers.path(name))
        self.special_as_text = special_as_text
        specials = {token.content: number for number, token in self.tokenizer.get_added_tokens_decoder().items()}
        self.specials = list(specials)
        self.apart, self.apart_id = max(specials.items(), key=lambda item: item[1])
        self.vocabulary = max(self.tokenizer.get_vocab_size(), 1 + max(specials.values()))
        self.byte_level = name.startswith("byte")
        self.line_id = self.tokenizer.encode("\n", add_special_tokens=False).ids[0] if self.byte_level else None
        self.model = Tokenizer(self.tokenizer.model)  # for words that need no cutting
        self.model.pre_tokenizer = CharDelimiterSplit("\n")
        self.width = np.zeros(self.vocabulary, np.int64)  # bytes that an id stands for
        for token, number in self.tokenizer.get_vocab(with_added_tokens=False).items():
            self.width[number] = len(token.removesuffix("</w>"))
        self.after_blank: dict[bytes, int] = {}  # places of words after a blank
        self.plain: dict[bytes, int] = {}  # places of all other pieces
        self._forget()

    def _forget(self) -> None:
        self.after_blank.clear()
        self.plain.clear()
        self.ids, self.used = np.zeros(1 << 16, np.uint32), 0  # of all pieces in turn
        self.starts, self.sizes, self.count = np.zeros(1 << 14, np.int64), np.zeros(1 << 14, np.int64), 0
        self._keep(np.array([END_ID], np.uint32), np.array([1]))  # place 0

    def _keep(self, ids: np.ndarray, sizes: np.ndarray) -> range:
        """Store the ids of pieces, which have these numbers of them; returns their places."""
        used, count = self.used + len(ids), self.count + len(sizes)
        if used > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros(max(used, len(self.ids)), np.uint32)])
        if count > len(self.sizes):
            more = np.zeros(max(count, len(self.sizes)), np.int64)
            self.starts, self.sizes = np.concatenate([self.starts, more]), np.concatenate([self.sizes, more])
        self.ids[self.used : used] = ids
        self.sizes[self.count : count] = sizes
        self.starts[self.count : count] = self.used + np.cumsum(sizes) - sizes
        places = range(self.count, count)
        self.used, self.count = used, count
        return places

    def encode(self, text: str | None) -> bytes:
        """The ids of a text as bytes; a null text is empty."""
        return self.encode_all([text])[0]

    def encode_all(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each text as little-endian bytes."""
        ids, ends = self.encode_column(pa.array(texts, pa.string()))
        raw, cuts = ids.astype("<u4").tobytes(), [0, *(4 * ends).tolist()]
        return [raw[a:b] for a, b in zip(cuts, cuts[1:])]

    def encode_column(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in turn, and where those of each text end; new pieces are gathered over all of them."""
        if len(self.plain) + len(self.after_blank) > REMEMBERED:
            self._forget()
        texts, whole = self._apart(pc.fill_null(texts.cast(pa.string()), ""))
        data, bounds = _bytes_of(texts)
        if not self.byte_level:
            data = _lowered(data)
        begins = _cuts(data, bounds[:-1])
        offsets = np.append(begins, len(data)).astype(np.int32)
        pieces = pa.BinaryArray.from_buffers(pa.binary(), len(begins), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))])
        pieces = pieces.dictionary_encode()
        places, stay = self._places(pieces.dictionary.to_numpy(zero_copy_only=False).tolist())
        places = np.append(0, places)
        first = np.searchsorted(begins, bounds[1:])  # of the pieces after each text
        order = np.insert(pieces.indices.to_numpy() + 1, first, 0)
        starts, sizes = self.starts[places], self.sizes[places][order]
        ends = np.cumsum(sizes)
        ids = self.ids[np.repeat(starts[order] - ends + sizes, sizes) + np.arange(sizes.sum())]
        self.used, self.count = stay
        ends = ends[first + np.arange(len(texts))]
        if whole:
            added = np.zeros(len(texts), np.int64)
            added[list(whole)] = [len(own) for own in whole.values()]
            ids = np.insert(ids, np.repeat(ends - 1, added), np.concatenate(list(whole.values())))
            ends = ends + np.cumsum(added)
        return ids, ends

    def _apart(self, texts: pa.Array) -> tuple[pa.Array, dict[int, np.ndarray]]:
        """Texts with those emptied that have to be encoded at once, and the ids of these, without the end's."""
        raw = _bytes_of(texts)[0].tobytes().lower()
        found = [special for special in self.specials if special.lower().encode() in raw]
        if not found:
            return texts, {}
        mask = pc.match_substring(texts, found[0], ignore_case=True)
        for special in found[1:]:
            mask = pc.or_(mask, pc.match_substring(texts, special, ignore_case=True))
        self.tokenizer.encode_special_tokens = self.special_as_text
        whole = {
            i: np.array(self.tokenizer.encode(texts[i].as_py(), add_special_tokens=False).ids, np.uint32)
            for i in np.flatnonzero(mask.to_numpy(zero_copy_only=False)).tolist()
        }
        return pc.if_else(mask, "", texts), whole

    def _places(self, pieces: list[bytes]) -> tuple[np.ndarray, tuple[int, int]]:
        """The place of each of these different pieces, and what is to stay stored after them: pieces too long are not kept."""
        places = np.array([place or 0 for place in map(self.after_blank.get, pieces)], np.int64)  # place 0 is the end's
        unknown = np.flatnonzero(places == 0)
        if self.plain and len(unknown):
            places[unknown] = [self.plain.get(pieces[i], 0) for i in unknown.tolist()]
            unknown = unknown[places[unknown] == 0]
        new = [pieces[i] for i in unknown.tolist()]
        word = np.array([match is not None for match in map(_WORD.fullmatch, new)], bool)
        blank = np.array([piece[0] == 0x20 for piece in new], bool)
        long = np.array(list(map(len, new)), np.int64) > _LONGEST
        stay = self.used, self.count
        for group, encode, known in (
            (word & blank & ~long, self._words, self.after_blank),
            (word & ~blank & ~long, self._words, self.plain),
            (~word & ~long, self._others, self.plain),
            (word & long, self._words, None),
            (~word & long, self._others, None),
        ):
            if group.any():
                own = [new[i] for i in np.flatnonzero(group).tolist()]
                at = self._keep(*encode(own))
                places[unknown[group]] = at
                if known is not None:
                    known.update(zip(own, at))
                    stay = self.used, self.count
        return places, stay

    def _encoded(self, tokenizer, texts: list[str]) -> list[np.ndarray]:
        calls = [texts[a : a + _CALL] for a in range(0, len(texts), _CALL)]
        return [np.array(e.ids, np.uint32) for call in calls for e in tokenizer.encode_batch_fast(call, add_special_tokens=False)]

    def _words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of words of Latin letters, by the model alone, and how many each has."""
        raw = [b"\n".join(words[a : a + _TOGETHER]) for a in range(0, len(words), _TOGETHER)]
        if not self.byte_level:
            raw = [text.replace(b" ", b"").decode().lower().encode() for text in raw]
        ids = np.concatenate(self._encoded(self.model, [_CHARACTERS[np.frombuffer(text, np.uint8)].tobytes().decode("utf-32-le") for text in raw]))
        joined = np.frombuffer(b"\n".join([*raw, b""]), np.uint8)
        ends = np.flatnonzero(joined == 0x0A)
        ends -= np.arange(len(ends))  # without the lines' ends
        reached = np.cumsum(self.width[ids])
        last = np.searchsorted(reached, ends)
        if len(ends) != len(words) or reached[-1] != ends[-1] or not np.array_equal(reached[last], ends):
            raise AssertionError("ids that do not spell the words")
        return ids, np.diff(last + 1, prepend=0)

    def _others(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of other pieces, by the whole tokenizer, and how many each has."""
        texts = [piece.decode() for piece in pieces]
        self.tokenizer.encode_special_tokens = False
        if self.line_id is None:
            return self._put_apart(texts, self.apart, self.apart_id)
        # the line's end is a token of its own next to pieces without white space, and quicker than a special token
        spaced = [not (bare := text.removeprefix(" ")) or _SPACED.search(bare) is not None for text in texts]
        split = [self._put_apart([t for t, s in zip(texts, spaced) if s], self.apart, self.apart_id)]
        split.append(self._put_apart([t for t, s in zip(texts, spaced) if not s], "\n", self.line_id))
        if not len(split[0][1]) or not len(split[1][1]):
            return split[not len(split[0][1])]
        # back in their order
        ids, sizes = (np.concatenate(both) for both in zip(*split))
        order = np.argsort(np.argsort(~np.array(spaced), kind="stable"), kind="stable")
        starts, sizes = (np.cumsum(sizes) - sizes)[order], sizes[order]
        ends = np.cumsum(sizes)
        return ids[np.repeat(starts - ends + sizes, sizes) + np.arange(ends[-1])], sizes

    def _put_apart(self, pieces: list[str], apart: str, apart_id: int) -> tuple[np.ndarray, np.ndarray]:
        texts = [apart.join(pieces[a : a + _TOGETHER]) for a in range(0, len(pieces), _TOGETHER)]
        ids = np.concatenate([np.append(own, np.uint32(apart_id)) for own in self._encoded(self.tokenizer, texts)] or [np.zeros(0, np.uint32)])
        ends = np.flatnonzero(ids == apart_id)
        if len(ends) != len(pieces):
            raise AssertionError("a piece holds what puts pieces apart")
        return ids[ids != apart_id], np.diff(ends, prepend=-1) - 1


_encoders: dict[tuple[str, str | None, bool], Encoder] = {}


def encoder(name: str, folder: str | None = None, special_as_text: bool = False) -> Encoder:
    """This Python worker's encoder; its memory of pieces outlives a task."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark already uses every core
    key = (name, folder, special_as_text)
    if key not in _encoders:
        _encoders.clear()
        _encoders[key] = Encoder(*key)
    return _encoders[key]


def narrow(ids: bytes | np.ndarray, vocabulary: int) -> np.ndarray:
    """Ids as unsigned 16-bit numbers; a vocabulary that needs more is refused."""
    if vocabulary > 1 << 16:
        raise ValueError(f"ids of a vocabulary of {vocabulary} do not fit into 16 bits")
    return np.frombuffer(ids, "<u4").astype("<u2")


def binary(values: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The bytes of each stretch of values, the first one from the beginning, without a copy."""
    offsets = np.append(0, ends * values.itemsize).astype(np.int32)
    return pa.BinaryArray.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(values)])
