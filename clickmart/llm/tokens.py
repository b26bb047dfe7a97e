"""Token ids by the ``tokenizers`` library, with a word cache per worker process.

Both vocabularies split a text into pieces that are encoded independently, so
a text is cut at places where such a split is certain and every distinct piece
is encoded once per worker. The ids are those of encoding the whole text.
"""

from __future__ import annotations

import os
import re
import sys
import types
import unicodedata
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Words a worker keeps at least, and at most about twice as many (about 50 bytes each).
CACHE_PIECES = 200_000

# A piece is white space with the word behind it. A blank or line feed after
# anything else starts a piece: no pre-token of either vocabulary reaches across.
# Texts without runs of white space are cut by Arrow at each blank, which is faster.
_PIECES = re.compile(r"[ \n]*[^ \n]+|[ \n]+")
_RUNS = r"[ \n][ \n]"
# Runs of mixed white space are one unit for the byte-level vocabulary: such a text is encoded whole.
# All that Python calls white space but the blank and the line feed.
_OTHER_SPACE = r"[\t\x0B-\r\x1C-\x1F\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
# Letters with a few marks behind them are two pre-tokens of either vocabulary. These letters are
# composed and have one lower-case form each, so that a plain lower-casing is what the normaliser makes of them.
_MARKS = ".,;:!?)"
_LETTERS = rf"^[A-Za-z\x{{C0}}-\x{{D6}}\x{{D8}}-\x{{F6}}\x{{F8}}-\x{{FF}}]+[{_MARKS}]{{0,3}}$"


def worker_store() -> types.ModuleType:
    """A namespace that lasts as long as the Python worker, across tasks."""
    return sys.modules.setdefault("_clickmart_worker", types.ModuleType("_clickmart_worker"))


def worker_kept(name: str, make: Callable[[], dict]) -> dict:
    """What a worker keeps under ``name`` from task to task, until it is asked for another's: jobs of
    several steps would otherwise hold the words of every step they have been through."""
    store = worker_store().__dict__
    if "kept" not in store or store["kept"][0] != name:
        store.pop("kept", None)
        pa.default_memory_pool().release_unused()
        store["kept"] = (name, make())
    return store["kept"][1]


class Recent:
    """What is known of the strings that were asked for last: of ``most`` at least and, new ones aside, at most twice as many.

    Those that come again and again stay; nothing is ever forgotten all at once.
    """

    def __init__(self, most: int):
        self.most = most
        self.now: dict = {}
        self.before: dict = {}

    def __len__(self) -> int:
        return len(self.now) + len(self.before)

    def find(self, strings: list[str]) -> list:
        """What is known of each string; None: nothing."""
        if len(self.now) >= self.most:
            self.now, self.before = {}, self.now
        found = list(map(self.now.get, strings))
        old = [i for i, value in enumerate(found) if value is None and strings[i] in self.before]
        for i in old:
            found[i] = self.now[strings[i]] = self.before[strings[i]]
        return found

    def add(self, strings: list[str], values: list) -> None:
        self.now.update(zip(strings, values, strict=True))


class Known:
    """Ids of the strings that were asked for last, in columns: of ``most`` at least and, new ones aside, at most twice as many.

    Those that come again and again stay, as in ``Recent``; a look-up is one of Arrow's and makes no strings.
    """

    def __init__(self, most: int):
        self.most, self.clock = most, 0
        self.strings = pa.array([], pa.large_string())
        self.ids = np.zeros(0, dtype="<u4")
        self.sizes = np.zeros(0, dtype=np.int64)
        self.asked = np.zeros(0, dtype=np.int64)

    def __len__(self) -> int:
        return len(self.sizes)

    def find(self, strings: pa.Array) -> np.ndarray:
        """The place of each string; -1: not known."""
        if len(self) > 2 * self.most:
            keep = np.sort(np.argpartition(-self.asked, self.most)[: self.most])
            starts = np.cumsum(self.sizes) - self.sizes
            self.ids, self.sizes, self.asked = self.ids[spans(starts[keep], self.sizes[keep])], self.sizes[keep], self.asked[keep]
            self.strings = self.strings.take(pa.array(keep))
        at = pc.fill_null(pc.index_in(strings, value_set=self.strings), -1).to_numpy().astype(np.int64)
        self.clock += 1
        self.asked[at[at >= 0]] = self.clock
        return at

    def add(self, strings: pa.Array, ids: np.ndarray, sizes: np.ndarray) -> None:
        self.strings = pa.concat_arrays([self.strings, strings])
        self.ids, self.sizes = np.concatenate([self.ids, ids]), np.concatenate([self.sizes, sizes])
        self.asked = np.concatenate([self.asked, np.full(len(sizes), self.clock)])


def spans(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The positions of many spans, one after another."""
    return np.repeat(starts - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())


def _byte_characters() -> dict[int, int]:
    """The characters that stand for bytes in byte-level vocabularies, where they are not those of Latin-1."""
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    return {b: 0x100 + i for i, b in enumerate(b for b in range(0x100) if b not in own)}


_BYTES = _byte_characters()

#: Unknown pieces that are encoded as one string.
JOINED = 500


def _strings(texts: list[str | None] | pa.Array) -> pa.Array:
    return texts.cast(pa.large_string()) if isinstance(texts, pa.Array) else pa.array(texts, pa.large_string())


def _cut(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """What stands between the blanks of all texts, and how many of it each has (NULL: none)."""
    lists = pc.split_pattern(texts, " ")
    return lists.flatten(), pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)


def _columns(lists: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Lists of ids as one, and how many each has."""
    return np.frombuffer(b"".join(lists), dtype="<u4"), np.array(list(map(len, lists)), dtype=np.int64) // 4


def _joined(columns: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    ids, sizes = zip(*columns, strict=True)
    return np.concatenate(ids), np.concatenate(sizes)


class Encoder:
    """Texts to little-endian unsigned 32-bit ids, as bytes."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        self.drops_space = self.tokenizer.normalizer is not None
        if self.drops_space:
            # What the normaliser does with ASCII text is to lower-case it: the same tokenizer without it takes such text faster.
            self.bare = Tokenizer.from_file(path)
            self.bare.encode_special_tokens = True
            self.bare.normalizer = None
        # Words of nothing but letters go to the vocabulary as they are: no pattern cuts them.
        self.letters = Tokenizer(self.tokenizer.model)
        self.words, self.pieces = Known(CACHE_PIECES), Recent(CACHE_PIECES // 4)
        self.marks: dict[str, bytes] = {}  # of at most three signs
        # Tokens are written with one character a byte; "</w>" marks a word's end.
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.bytes_of = np.zeros(max(vocabulary.values()) + 1, dtype=np.int64)
        for token, i in vocabulary.items():
            self.bytes_of[i] = len(token.removesuffix("</w>") if self.drops_space else token)

    def _plain(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, dtype="<u4").tobytes() for e in found]

    def _join(self, pieces: list[str]) -> list[bytes]:
        """Encode many pieces as one string and part its ids by the bytes they stand for."""
        def size(piece: str) -> int:
            if piece.isascii():
                return len(piece)
            return len((unicodedata.normalize("NFC", piece).lower() if self.drops_space else piece).encode("utf-8", "surrogatepass"))

        text = (" " if self.drops_space else "").join(pieces)
        ends = np.cumsum(list(map(len if text.isascii() else size, pieces)))
        tokenizer = self.tokenizer
        if self.drops_space and text.isascii():
            tokenizer, text = self.bare, text.lower()
        found = self._parted(tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, ends)
        if found is None:  # a character whose normal form has another length
            return self._plain(pieces)
        raw, stops = found[0].tobytes(), (4 * np.cumsum(found[1])).tolist()
        return [raw[i:j] for i, j in zip([0, *stops[:-1]], stops, strict=True)]

    def _parted(self, ids: list[int], ends: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids, and how many of them lie up to each of so many coded bytes from the one before; None if a token reaches across."""
        ids = np.array(ids, dtype="<u4")
        at = np.cumsum(self.bytes_of[ids])
        cuts = np.searchsorted(at, ends, side="left") + 1
        if not len(ids) or cuts[-1] != len(ids) or (at[cuts - 1] != ends).any():
            return None
        return ids, np.diff(cuts, prepend=0)

    def _whole(self, word: str) -> str:
        """What a word between blanks stands for: where blanks are not dropped, itself with the one before it."""
        return word if self.drops_space or word.startswith("\n") else " " + word

    def _encode_letters(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words of nothing but letters, and how many each has."""
        before, out = "" if self.drops_space else chr(_BYTES[0x20]), []
        for at in range(0, len(words), JOINED):
            part = words[at : at + JOINED]
            text = "!".join(part)  # which is in no word
            text = text if text.isascii() else text.encode().decode("latin-1").translate(_BYTES)
            coded = [before + w for w in text.split("!")]
            ids = self.letters.encode_batch_fast([coded], is_pretokenized=True, add_special_tokens=False)[0].ids
            out.append(self._parted(ids, np.cumsum(list(map(len, coded)))) or _columns(self._plain(list(map(self._whole, part)))))
        return _joined(out)

    def _code_words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct words between blanks, and how many each has. Letters are looked up apart from the marks behind them,
        in lower case where the vocabulary has no other."""
        simple = pc.match_substring_regex(words, _LETTERS)
        some, others = words.filter(simple), words.filter(pc.invert(simple))
        letters = pc.utf8_rtrim(some, _MARKS)
        marks = (pc.binary_length(some).to_numpy() - pc.binary_length(letters).to_numpy()).astype(np.int64)
        coded = (pc.utf8_lower(letters) if self.drops_space else letters).dictionary_encode()
        at = self.words.find(pa.concat_arrays([coded.dictionary, others]))
        new, n = np.flatnonzero(at < 0), len(coded.dictionary)
        for strings, first, encode in ((coded.dictionary, 0, self._encode_letters), (others, n, lambda part: _columns(self._encode_new(list(map(self._whole, part)))))):
            own = new[(new >= first) & (new < first + len(strings))]
            if len(own):
                strings = strings.take(pa.array(own - first))
                at[own] = len(self.words) + np.arange(len(own))
                self.words.add(strings, *encode(strings.to_numpy(zero_copy_only=False).tolist()))  # many times as fast as to_pylist
        # Two spans a word: itself, and its marks.
        place = np.empty(len(words), dtype=np.int64)
        is_simple = simple.to_numpy(zero_copy_only=False)
        place[is_simple], place[~is_simple] = at[coded.indices.to_numpy()], at[n:]
        signs, signs_sizes, behind = self._code_marks(some, marks)
        starts, sizes = np.zeros((len(words), 2), dtype=np.int64), np.zeros((len(words), 2), dtype=np.int64)
        sizes[:, 0] = self.words.sizes[place]
        starts[:, 0] = (np.cumsum(self.words.sizes) - self.words.sizes)[place]
        sizes[is_simple, 1] = signs_sizes[behind]
        starts[is_simple, 1] = len(self.words.ids) + (np.cumsum(signs_sizes) - signs_sizes)[behind]
        return np.concatenate([self.words.ids, signs])[spans(starts.ravel(), sizes.ravel())], sizes.sum(axis=1)

    def _code_marks(self, words: pa.Array, marks: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids and sizes of the distinct endings of so many signs, and which of them each word has."""
        key = np.zeros(len(words), dtype=np.int64)
        if marks.any():
            _, offsets, data = words.buffers()
            ends, data = np.frombuffer(offsets, dtype=np.int64)[words.offset + 1 :], np.frombuffer(data, dtype=np.uint8)
            for i in range(3, 0, -1):
                has = np.flatnonzero(marks >= i)
                key[has] = key[has] << 8 | data[ends[has] - i]
        endings, behind = np.unique(key, return_inverse=True)
        texts = [int(k).to_bytes(3).lstrip(b"\0").decode() for k in endings]
        for text in texts:
            if text not in self.marks:
                self.marks[text] = self._plain([text])[0]
        return *_columns([self.marks[text] for text in texts]), behind

    def _encode_new(self, pieces: list[str]) -> list[bytes]:
        """Ids of pieces. Those that start with white space (or any, where it is dropped) can stand side by side."""
        side = [i for i, p in enumerate(pieces) if p and (self.drops_space or (p[0] in " \n" and p[-1] not in " \n"))]
        out: list[bytes] = [b""] * len(pieces)
        for group in ([i for i in side if pieces[i].isascii()], [i for i in side if not pieces[i].isascii()]):
            for at in range(0, len(group), JOINED):
                part = group[at : at + JOINED]
                for i, ids in zip(part, self._join([pieces[i] for i in part]), strict=True):
                    out[i] = ids
        alone = sorted({*range(len(pieces))}.difference(side))
        for i, ids in zip(alone, self._plain([pieces[i] for i in alone]), strict=True):
            out[i] = ids
        return out

    def _look_up(self, parts: pa.Array, counts: np.ndarray) -> list[bytes]:
        """Ids of texts that are cut into so many ``parts`` each."""
        coded = parts.dictionary_encode()
        distinct = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        found = self.pieces.find(distinct)
        new = [i for i, ids in enumerate(found) if ids is None]
        if new:
            ids_new = self._encode_new([distinct[i] for i in new])
            self.pieces.add([distinct[i] for i in new], ids_new)
            for i, ids in zip(new, ids_new, strict=True):
                found[i] = ids
        sizes = np.fromiter(map(len, found), dtype=np.int64, count=len(found)) // 4
        starts, ids = np.cumsum(sizes) - sizes, np.frombuffer(b"".join(found), dtype="<u4")
        code = coded.indices.to_numpy()
        n = sizes[code]
        ends = np.concatenate([[0], np.cumsum(n)])
        raw = ids[np.repeat(starts[code] - ends[:-1], n) + np.arange(ends[-1])].tobytes()
        stops = (4 * ends[np.concatenate([[0], np.cumsum(counts)])]).tolist()
        return [raw[i:j] for i, j in zip(stops, stops[1:], strict=False)]

    def _look_up_words(self, words: pa.Array, counts: np.ndarray) -> list[bytes]:
        """Ids of texts that have so many words each."""
        coded = words.dictionary_encode()
        ids, sizes = self._code_words(coded.dictionary)
        ends = np.concatenate([[0], np.cumsum(sizes * 4)])
        table = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(sizes), [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(ids)])
        found = table.take(coded.indices)
        stops = np.concatenate([[0], np.cumsum(pc.binary_length(found).to_numpy())])[np.concatenate([[0], np.cumsum(counts)])].tolist()
        raw = found.buffers()[2] or b""
        return [bytes(raw[i:j]) for i, j in zip(stops, stops[1:], strict=False)]

    def encode_all(self, texts: list[str] | pa.Array) -> list[bytes]:
        column = _strings(texts)
        if self.drops_space:
            return self._look_up_words(*_cut(pc.replace_substring(column, "\n", " ")))
        if isinstance(texts, pa.Array):
            texts = texts.to_pylist()
        out: list[bytes | None] = [None] * len(texts)
        other, run = (pc.match_substring_regex(column, p).to_numpy(zero_copy_only=False).astype(bool) for p in (_OTHER_SPACE, _RUNS))
        plain, runs, words = (np.flatnonzero(x).tolist() for x in (other, run & ~other, ~(run | other)))
        # A word without its blank stands for both; the first of a text has no blank before it.
        cut = [texts[i].replace("\n", " \n").partition(" ") for i in words]
        heads = self._plain([head for head, _, _ in cut])
        tails = self._look_up_words(*_cut(_strings([tail if blank else None for _, blank, tail in cut])))
        lists = [_PIECES.findall(texts[i]) for i in runs]
        found = (
            (plain, self._plain([texts[i] for i in plain])),
            (runs, self._look_up(_strings([p for x in lists for p in x]), np.array(list(map(len, lists)), dtype=np.int64))),
            (words, map(bytes.__add__, heads, tails)),
        )
        for part, ids in found:
            for i, one in zip(part, ids, strict=True):
                out[i] = one
        return out

    def encode(self, text: str) -> bytes:
        return self.encode_all([text])[0]

    def forget(self) -> None:
        """What it has learned from texts goes."""
        self.words, self.pieces = Known(CACHE_PIECES), Recent(CACHE_PIECES // 4)
        pa.default_memory_pool().release_unused()

    @property
    def vocabulary(self) -> int:
        return self.tokenizer.get_vocab_size(with_added_tokens=True)


#: Bytes of texts that are worked on at a time; a longer text is alone.
CHUNK_BYTES = 1 << 21


def chunks(texts: pa.Array, most: int = CHUNK_BYTES) -> Iterator[pa.Array]:
    """A column of texts in runs of at most so many bytes."""
    ends, at = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)), 0
    while at < len(texts):
        end = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + most, side="right")))
        yield texts.slice(at, end - at)
        at = end


def batch_chunks(batch: pa.RecordBatch, text: str, most: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """A batch in runs of rows with at most so many bytes of text."""
    at = 0
    for texts in chunks(batch.column(text), most):
        yield batch.slice(at, len(texts))
        at += len(texts)


def encoder(path: str) -> Encoder:
    """This worker's encoder for a tokenizer file."""
    store = worker_kept("encoders", dict)
    if path not in store:
        store[path] = Encoder(path)
    return store[path]


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)
