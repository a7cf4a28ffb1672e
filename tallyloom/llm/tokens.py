"""Exact token ids of whole texts, and the token count of every prefix of a text.

A text is cut at spaces where no tokenizer rule looks across the cut; the ids of a chunk
are then worked out once per Python worker and looked up afterwards. Chunks of plain
letters, digits and punctuation are split into the tokenizer's own pieces and given to
the model of the ``tokenizers`` library; all other chunks, and texts in which a special
string or an unusual run of white space occurs, go through the library as they are.
"""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Iterator
from operator import sub
from os.path import commonprefix

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from tokenizers import Tokenizer

from tallyloom.llm.common import GOLDEN, BoundedMemo, mixed, process_memo

#: Entries of a worker's memos; tokenizers by words have two, and stand beside the pipeline's other stages.
MEMO_ENTRIES, WORD_ENTRIES = 900_000, 400_000
LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
#: Characters whose class is the same in every Unicode version; the apostrophe has rules of its own.
PLAIN = re.compile(rf"[\n !-&(-~{LETTERS}]*\Z").match
LETTERS_ONLY = re.compile(rf" ?[{LETTERS}]+\Z").match
#: A mark at the end of a word is a piece of its own.
ENDINGS = tuple(".,;:!?")
#: Slots of a word table, and eights of bytes of a word that has one (32 MB in all).
SLOTS, EIGHTS = 1 << 20, 3
TWO_SPACES = re.compile(r"[ \n][ \n]").search
BYTE_PIECES = re.compile(rf" ?[{LETTERS}]+| ?[0-9]+| ?[^\s{LETTERS}0-9]+|\s+(?!\S)|\s+")
WORD_PIECES = re.compile(rf"[{LETTERS}]+|[0-9]|[^\s{LETTERS}0-9]+")
#: A run of three or more white spaces, or of two at the end: cutting inside it could change the pieces.
UNSAFE_RUN = re.compile(r"\s\s(?:\s|\Z)").search
TWO_BLANKS = re.compile(r"\s\s").search
#: Controls that count as white space here but not in every rule set.
SEPARATORS = re.compile("[\x1c-\x1f]").search
BLANKS_AND_WORD = re.compile(r"\s*\S+|\s+\Z")
Chunks = tuple[list[str], np.ndarray, np.ndarray]
RUNS = regex.compile(r"\s+|\S+")
#: Contractions of more than two characters in the split rule below (fixed values).
CONTRACTIONS = ("'ll", "'ve", "'re")
#: The split rule of byte-level tokenizers (a published, fixed pattern).
BYTE_LEVEL_SPLIT = regex.compile(r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")


def byte_alphabet() -> dict[int, str]:
    """The printable stand-in of each byte in byte-level vocabularies: itself, or the next code point from 256."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


#: White space of plain chunks in that alphabet.
SHOWN = {10: byte_alphabet()[10], 32: byte_alphabet()[32]}


def as_alphabet(piece: str, table: dict[int, str]) -> str:
    return piece.encode("utf-8", "surrogatepass").decode("latin-1").translate(table)


def read_told(path: str) -> dict:
    """What a tokenizer file tells; not kept, as it takes as much as many thousand words."""
    with open(path, encoding="utf-8") as file:
        return json.load(file)


class TextEncoder:
    """``encode(text)``: the ids that the library gives, as little-endian unsigned 32-bit integers."""

    def __init__(self, path: str):
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        told = read_told(path)
        self.special = [t["content"] for t in told["added_tokens"]]
        self.kind = self._kind(told)
        self.tokenize, self.table = self.library.model.tokenize, byte_alphabet()
        by_word = self.kind == "words"
        self.known = BoundedMemo(self._word if by_word else self._chunk, WORD_ENTRIES if by_word else MEMO_ENTRIES)
        #: Numbers of ids of lower-cased words of letters, and of the marks after them.
        self.counted, self.marks = BoundedMemo(self.count_word, WORD_ENTRIES), {}

    @staticmethod
    def _kind(told: dict) -> str:
        before, first = told["normalizer"], told["pre_tokenizer"] or {}
        if told["model"]["type"] != "BPE" or told["model"].get("dropout"):
            return "whole"
        if before is None and first.get("type") == "ByteLevel" and first["use_regex"] and not first["add_prefix_space"]:
            return "bytes"
        steps = [s["type"] for s in (before or {}).get("normalizers", [])]
        split = first.get("pretokenizers", [{}])
        by_word = steps == ["NFC", "Replace", "Lowercase"] and [s.get("type") for s in split] == ["Split", "ByteLevel"]
        pattern = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
        return "words" if by_word and split[0]["pattern"].get("Regex") == pattern and split[0]["invert"] else "whole"

    def _piece(self, piece: str) -> bytes:
        """The ids of one piece of the tokenizer's split."""
        shown = piece.translate(SHOWN) if piece.isascii() else as_alphabet(piece, self.table)
        return array("I", [t.id for t in self.tokenize(shown)]).tobytes()

    def _library(self, text: str) -> bytes:
        return array("I", self.library.encode(text, add_special_tokens=False).ids).tobytes()

    def _chunk(self, chunk: str) -> bytes:
        word = chunk[1:] if chunk[:1] == " " else chunk
        if word.isascii():
            if word.isalpha():
                return self._piece(chunk)
            if word[-1:] in ENDINGS and word[:-1].isalpha():
                return self.known[chunk[:-1]] + self.known[word[-1]]
        if LETTERS_ONLY(chunk):
            return self._piece(chunk)
        if PLAIN(chunk):
            pieces = BYTE_PIECES.findall(chunk)
            return self._piece(chunk) if len(pieces) == 1 else b"".join(map(self.known.__getitem__, pieces))
        return self._library(chunk)

    def _word(self, chunk: str) -> bytes:
        if chunk.isascii():
            if chunk.isalpha():
                return self._piece(chunk.lower())
            if chunk[-1:] in ENDINGS and chunk[:-1].isalpha():
                return self.known[chunk[:-1]] + self.known[chunk[-1]]
        if LETTERS_ONLY(chunk):
            return self._piece(chunk.lower())
        if PLAIN(chunk):
            pieces = WORD_PIECES.findall(chunk)
            return self._piece(chunk.lower()) if pieces == [chunk] else b"".join(map(self.known.__getitem__, pieces))
        return self._library(chunk)

    def stays_whole(self, text: str) -> bool:
        """Whether no cut is safe: a special string, a NUL (which marks the cuts), or an unusual run of white space."""
        if self.kind == "whole" or "\0" in text or any(x in text for x in self.special):
            return True
        return self.kind == "bytes" and UNSAFE_RUN(text) is not None

    def encode_all(self, texts: pa.Array) -> Iterator[bytes]:
        self.counted.clear()  # whoever wants ids has counted before
        return by_chunk(self.kind, texts, self.known, self.stays_whole, self._library)

    def count_all(self, texts: pa.Array) -> np.ndarray:
        """The number of ids of each text."""
        return self.count_chunks(texts, chunks(self.kind, texts))[0]

    def count_whole(self, text: str) -> int:
        """The number of ids of a text that is not cut."""
        return len(self._library(text)) // 4

    def count_word(self, word: str) -> int:
        """The number of ids of a run of lower-case letters, for a tokenizer by words."""
        return len(self.tokenize(word if word.isascii() else as_alphabet(word, self.table)))

    def _sizes(self, distinct: list[str]) -> np.ndarray:
        """The numbers of ids of chunks of a tokenizer by words: a word's, whatever its case and the mark after it."""
        if not self.marks:
            self.marks.update({m: len(self.known[m]) // 4 for m in ENDINGS})
        marks, counted, known = self.marks, self.counted, self.known

        def size(chunk: str) -> int:
            word, mark = (chunk[:-1], marks[chunk[-1]]) if chunk[-1:] in marks else (chunk, 0)
            if word.isalpha() if word.isascii() else LETTERS_ONLY(word):
                return counted[word.lower()] + mark
            return len(known[chunk]) // 4

        return np.fromiter(map(size, distinct), np.int64, len(distinct))

    def count_chunks(self, texts: pa.Array, cut: Chunks) -> tuple[np.ndarray, dict[int, str]]:
        """The number of ids of each text, given their chunks, and the texts that stay uncut."""
        alone = {i: t for i, t in enumerate(texts.to_pylist()) if self.stays_whole(t)}
        if alone or self.kind != "words":
            alone, values, places, starts = looked_up(self.kind, texts, self.known, self.stays_whole, cut=cut)
            sizes = np.array([len(v) for v in values], np.int64) // 4
        else:
            distinct, places, starts = cut
            sizes = self._sizes(distinct)
        sums = np.concatenate([[0], np.cumsum(sizes[places])])
        counts = sums[starts[1:]] - sums[starts[:-1]]
        for i, text in alone.items():
            counts[i] = self.count_whole(text)
        return counts, alone


def by_chunk(kind: str, texts: pa.Array, known: BoundedMemo, stays_whole, whole, in_order: bool = False) -> Iterator[bytes]:
    """For each text the looked-up values of its chunks one after another; ``whole`` gives those of uncut texts.

    Each distinct chunk of the batch is looked up once, ``in_order`` if that helps the look-up.
    """
    alone, values, places, starts = looked_up(kind, texts, known, stays_whole, in_order)
    for i in range(len(starts) - 1):
        if i in alone:
            yield whole(alone[i])
        else:
            yield b"".join([values[k] for k in places[starts[i] : starts[i + 1]].tolist()])


def looked_up(kind: str, texts: pa.Array, known: BoundedMemo, stays_whole, in_order: bool = False, cut: Chunks | None = None) -> tuple[dict[int, str], list[bytes], np.ndarray, np.ndarray]:
    """The uncut texts by place, the distinct chunks' values, the value's place of every chunk, and where each text's chunks start."""
    alone = {i: t for i, t in enumerate(texts.to_pylist()) if stays_whole(t)}
    distinct, places, starts = cut or chunks(kind, texts)
    values: list[bytes] = [b""] * len(distinct)
    if alone:  # chunks of uncut texts are not needed
        wanted = {distinct[k] for i in range(len(texts)) if i not in alone for k in set(places[starts[i] : starts[i + 1]].tolist())}
    order = sorted(range(len(distinct)), key=distinct.__getitem__) if in_order else range(len(distinct))
    for i in order:
        if not alone or distinct[i] in wanted:
            values[i] = known[distinct[i]]
    return alone, values, places, starts


def coded_chunks(kind: str, texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The distinct chunks of a batch, the place of every chunk among them, and where each text's chunks start."""
    if kind == "words":
        texts = pc.replace_substring(texts, "\n", "\0")
        marked = pc.replace_substring(texts, " ", "\0")
    else:
        marked = pc.replace_substring(pc.replace_substring(texts, " ", "\0 "), "\n", "\0\n")
    cut = pc.split_pattern(marked, "\0")
    coded = cut.flatten().dictionary_encode()
    return coded.dictionary, coded.indices.to_numpy(zero_copy_only=False), cut.offsets.to_numpy() - cut.offsets[0].as_py()


def chunks(kind: str, texts: pa.Array) -> Chunks:
    """As :func:`coded_chunks`, the chunks as a list."""
    distinct, places, starts = coded_chunks(kind, texts)
    return strings(distinct), places, starts


def strings(texts: pa.Array) -> list[str]:
    """Made ten times as fast through NumPy as by ``to_pylist()``."""
    return texts.to_numpy(zero_copy_only=False).tolist()


class WordTable:
    """Two numbers of each word's stem (its ASCII letters in lower case, a mark at its end left out), kept from batch to batch.

    A stem of at most ``8 * EIGHTS`` bytes stays in the slot that its bytes' hash gives,
    beside the bytes themselves, until another one needs the slot. So a few array
    operations look up a batch, and ``work`` is called for stems that are not there.
    """

    def __init__(self, work, slots: int):
        self.work, self.mask = work, np.uint64(slots - 1)
        # The bytes, then both numbers. A slot not yet used is that of the empty stem.
        self.slots = np.zeros((slots, EIGHTS + 1), np.uint64)
        self.slots[:, EIGHTS:] = np.array([work("")], np.int32).view(np.uint64)
        self.ends = np.isin(np.arange(256), [ord(m) for m in ENDINGS])

    def look_up(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The numbers of each word's stem, and the mark after it as a byte (0: none)."""
        low = pc.ascii_lower(words.cast(pa.string()))
        offsets = np.frombuffer(low.buffers()[1], np.int32, len(low) + 1, 4 * low.offset).astype(np.int64) if len(low) else np.zeros(1, np.int64)
        data = np.zeros(offsets[-1] + 8 * EIGHTS, np.uint8)
        if offsets[-1]:
            data[: offsets[-1]] = np.frombuffer(low.buffers()[2], np.uint8, offsets[-1])
        starts, sizes, last = offsets[:-1], np.diff(offsets), data[offsets[1:] - 1]
        marks = np.where(self.ends[last] & (sizes > 0), last, 0)
        sizes = sizes - (marks > 0)
        # Eight bytes from any place on, of which those after the stem are cleared.
        eights = np.ndarray(len(data) - 7, "<u8", data, strides=(1,))
        kept = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)
        keys = np.stack([eights[starts + 8 * i] & kept[np.clip(sizes - 8 * i, 0, 8)] for i in range(EIGHTS)], 1)
        slots = np.zeros(len(low), np.uint64)
        for i in range(EIGHTS):
            slots = mixed(slots * GOLDEN ^ keys[:, i])
        slots = (slots & self.mask).astype(np.int64)
        fits, held = sizes <= 8 * EIGHTS, self.slots.take(slots, axis=0)
        numbers = held[:, EIGHTS:].copy().view(np.int32)
        new = np.flatnonzero(~((held[:, :EIGHTS] == keys).all(axis=1) & fits))
        if len(new):
            stems = [w[:-1] if m else w for w, m in zip(strings(low.take(pa.array(new))), marks[new].tolist())]
            found = {s: self.work(s) for s in set(stems)}
            numbers[new] = [found[s] for s in stems]
            new = new[fits[new]]
            own, first = np.unique(slots[new], return_index=True)
            self.slots[own] = np.concatenate([keys, numbers.view(np.uint64)], 1)[new[first]]
        return numbers, marks


def encoder(path: str) -> TextEncoder:
    """The worker's encoder for a tokenizer file."""
    return process_memo(f"encoder {path}", lambda: TextEncoder(path))


class PrefixCounter:
    """Counts the tokens of every prefix of a text by dynamic programming, for byte-level BPE.

    The last token of each prefix is found from those of shorter prefixes: a token may
    follow the last token of the prefix before it exactly if no merge joins them across
    their boundary. One token fits at each place, so a piece of n bytes takes n steps and
    no prefix is encoded again.
    """

    def __init__(self, path: str):
        self.text = encoder(path)
        if self.text.kind != "bytes":
            raise ValueError("prefix counts need a byte-level BPE tokenizer without a normalizer")
        self.vocabulary = self.text.library.get_vocab(with_added_tokens=False)
        self.longest = max(map(len, self.vocabulary))
        pairs = [m if isinstance(m, list) else m.split(" ") for m in read_told(path)["model"]["merges"]]
        ids = self.vocabulary
        self.ranks = {(ids[a] << 32) + ids[b]: r for r, (a, b) in enumerate(pairs)}
        self.halves = {ids[a + b]: (ids[a], ids[b], r) for r, (a, b) in reversed(list(enumerate(pairs)))}
        # A vocabulary may hold tokens that its merges never make; such a token ends no prefix.
        self.made = {t: i for t, i in ids.items() if [x.id for x in self.text.tokenize(t)] == [i]}
        #: The length of the longest token that ends with given three characters.
        self.reach = {}
        for token in self.made:
            self.reach[token[-3:]] = max(self.reach.get(token[-3:], 2), len(token))
        self.piece, self.last, self.counts = "", [0], [0]
        self.edges = (BoundedMemo(lambda t: self._edge(t, 1), 1 << 20), BoundedMemo(lambda t: self._edge(t, 0), 1 << 20))
        self.follows = BoundedMemo(self._follows, MEMO_ENTRIES)
        self.known = BoundedMemo(self._steps, MEMO_ENTRIES)

    def _edge(self, token: int, side: int) -> list[tuple[int, float]]:
        """The parts that stand at one edge of a token while it is made, each with the rank of the merge that uses it up."""
        out, used = [], float("inf")
        while True:
            out.append((token if side == 0 else token << 32, used))
            if token not in self.halves:
                return out
            used, token = self.halves[token][2], self.halves[token][side]

    def _follows(self, pair: int) -> bool:
        """Whether two tokens side by side stay as they are.

        A merge across the boundary happens if it comes before the merges that use up its
        two parts; of equal ranks the one further left comes first.
        """
        ranks = self.ranks
        right_edge, left_edge = self.edges[0][pair >> 32], self.edges[1][pair & 0xFFFFFFFF]
        for a, used_a in right_edge:
            for b, used_b in left_edge:
                rank = ranks.get(a + b)
                if rank is not None and rank < used_a and rank <= used_b:
                    return False
        return True

    def piece_counts(self, piece: str) -> list[int]:
        """Tokens of the first 1, 2, ... bytes of one piece, given in the vocabulary's alphabet.

        Goes on from the part that the piece shares with the one before it.
        """
        token_of, follows, reach = self.made.get, self.follows, self.reach
        shared = len(commonprefix((piece, self.piece)))
        last, counts = self.last, self.counts
        del last[shared + 1 :], counts[shared + 1 :]
        for end in range(shared + 1, len(piece) + 1):
            token = token_of(piece[:end]) if end <= self.longest else None
            if token is not None:
                last.append(token)
                counts.append(1)
                continue
            for start in range(max(1, end - reach.get(piece[max(end - 3, 0) : end], 2)), end):
                token = token_of(piece[start:end])
                if token is not None and follows[(last[start] << 32) + token]:
                    break
            last.append(token)
            counts.append(counts[start] + 1)
        self.piece = piece
        return counts[1:]

    def plain_counts(self, text: str) -> list[int]:
        """Tokens of the first 1, 2, ... code points of a text in which no special string is complete."""
        out: list[int] = []
        before, lead = 0, ""
        for run in RUNS.findall(text):
            if run[0].isspace():
                # A prefix that ends inside a run of white space sees the run so far as one piece;
                # a word after it leaves the run without its last character, which is a space of
                # the word's own piece or a piece by itself.
                out.extend(before + c for c in self._run(run))
                lead = run[-1] if run[-1] == " " else ""
                before += (self._run(run[:-1])[-1] if len(run) > 1 else 0) + (0 if lead else self._run(run[-1])[-1])
                continue
            for piece in BYTE_LEVEL_SPLIT.findall(lead + run):
                counts = self._run(piece)
                if piece in CONTRACTIONS:  # a part of it is no contraction yet, so two pieces
                    counts[1] = counts[0] + self._run(piece[1])[0]
                out.extend(before + c for c in counts[len(lead) :])
                before, lead = before + counts[-1], ""
        return out

    def _run(self, piece: str) -> list[int]:
        """Tokens after each code point of one piece."""
        if piece.isascii():
            return self.piece_counts(piece.translate(SHOWN) if PLAIN(piece) else as_alphabet(piece, self.text.table))
        counts = self.piece_counts(as_alphabet(piece, self.text.table))
        ends = np.cumsum([len(c.encode("utf-8", "surrogatepass")) for c in piece]) - 1
        return [counts[e] for e in ends]

    def _steps(self, chunk: str) -> bytes:
        word = chunk[1:] if chunk[:1] == " " else chunk
        if word.isascii() and word[-1:] in ENDINGS and word[:-1].isalpha():
            return self.known[chunk[:-1]] + self.known[word[-1]]
        if LETTERS_ONLY(chunk):
            return as_steps(self._run(chunk))
        if PLAIN(chunk) and not TWO_SPACES(chunk):  # the pieces of every prefix are those of the chunk, the last one cut
            pieces = BYTE_PIECES.findall(chunk)
            return as_steps(self._run(chunk)) if len(pieces) < 2 else b"".join(map(self.known.__getitem__, pieces))
        counts = self.plain_counts(chunk)
        if chunk and counts[-1] != self._encoded(chunk):
            counts = [self._encoded(chunk[: i + 1]) for i in range(len(chunk))]
        return as_steps(counts)

    def _encoded(self, text: str) -> int:
        return len(self.text.library.encode(text, add_special_tokens=False).ids)

    def prefix_counts(self, text: str) -> list[int]:
        """As :meth:`plain_counts`, for any text."""
        out: list[int] = []
        before, at = 0, 0
        for match in re.finditer("|".join(map(re.escape, self.text.special)) or r"(?!)", text):
            part, special = text[at : match.start()], match.group()
            inside = self.plain_counts(part + special[:-1])
            out.extend(before + c for c in inside)
            before += (inside[len(part) - 1] if part else 0) + 1
            out.append(before)
            at = match.end()
        out.extend(before + c for c in self.plain_counts(text[at:]))
        if text and out[-1] != self._encoded(text):
            return [self._encoded(text[: i + 1]) for i in range(len(text))]
        return out

    def stays_whole(self, text: str) -> bool:
        """Also where two white spaces meet: a prefix that ends between them and one that ends after them differ in pieces."""
        return TWO_BLANKS(text) is not None or self.text.stays_whole(text)

    def _whole(self, text: str) -> bytes:
        if SEPARATORS(text) or "\0" in text or any(x in text for x in self.text.special):
            return as_steps(self.prefix_counts(text))
        return b"".join(map(self.known.__getitem__, BLANKS_AND_WORD.findall(text)))

    def steps_all(self, texts: pa.Array) -> Iterator[bytes]:
        """For each text the change of the count at each code point, as little-endian 16-bit integers."""
        return by_chunk("bytes", texts, self.known, self.stays_whole, self._whole, in_order=True)


def as_steps(counts: list[int]) -> bytes:
    """The changes from count to count; no code point changes a count by what 16 bits can't hold, else this fails loudly."""
    return array("h", map(sub, counts, [0, *counts])).tobytes()


def counter(path: str) -> PrefixCounter:
    """The worker's prefix counter for a tokenizer file."""
    return process_memo(f"counter {path}", lambda: PrefixCounter(path))
