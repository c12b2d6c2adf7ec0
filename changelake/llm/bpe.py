"""BPE encoding and decoding by backtracking over longest matches.

The usual way to apply merges looks for the best pair again and again.  Here the
trie of an Aho-Corasick automaton over the token strings yields, for a position that the encoder
reaches, the longest token that starts there; a chain of shorter tokens hangs below it.  A sequence of tokens is the
one that the merges would give exactly if every two neighbours are *compatible*: undoing
their last merges step by step never uncovers a pair that would have been merged earlier.
So the encoder takes the longest token, checks it against its left neighbour in a
pair-compatibility table (filled on first use), takes the next shorter token on failure
and goes back a token when none is left; positions known to be dead ends are never tried
twice, which keeps the time linear in the text.

Decoding is a gather from one byte string of all token strings by a table of offsets.

Defined results: a null text is the empty text (no ids); ids are those of
``tokenizers`` with ``add_special_tokens=False``; special tokens written out in a text
become their id; decoding joins the token strings by a space where the tokenizer file
names no decoder.  Rows are handled one by one in Arrow batches, so memory is bounded by
the longest text; repeated rows and ids stay repeated.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from collections.abc import Iterator
from struct import pack

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import in_slices, per_worker, pick

# words whose ids a worker remembers at most, in two generations
MEMO_WORDS = 400_000

# The split pattern of the tokenizer file; {L}, {N} and {S} stand for the
# Unicode letters, numbers and white space.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[{L}]+|[{N}]|[^{S}{L}{N}]+"
WHITE_SPACE = r"\x09-\x0D\x20\x85\xA0\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000"

END = "\ue000"  # stands for the end-of-word suffix inside the automaton's strings


def byte_alphabet() -> list[str]:
    """The printable character that byte-level vocabularies write for each byte.

    Printable Latin-1 bytes stand for themselves, the others get the next free code
    points from 256 on, in order.
    """
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    out, free = [], 256
    for b in range(256):
        if b in plain:
            out.append(chr(b))
        else:
            out.append(chr(free))
            free += 1
    return out


def category_class(kind: str, below: int = 0x110000) -> str:
    """The inside of a character class of all code points under ``below`` whose category starts with ``kind``."""
    out, start = [], None
    for c in range(below + 1):
        inside = c < below and unicodedata.category(chr(c))[0] == kind
        if inside and start is None:
            start = c
        elif not inside and start is not None:
            out.append(f"\\U{start:08x}-\\U{c - 1:08x}")
            start = None
    return "".join(out)


class BacktrackingBpe:
    """Encoder and decoder for a word-level BPE file with an end-of-word suffix."""

    def __init__(self, model: str):
        spec = json.loads(model)
        vocab: dict[str, int] = spec["model"]["vocab"]
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in spec["model"]["merges"]]
        suffix = spec["model"]["end_of_word_suffix"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        alphabet = byte_alphabet()

        def inner(token: str) -> str:
            return token[: -len(suffix)] + END if token.endswith(suffix) else token

        # own numbering: single symbols first, then one number per merge in merge order,
        # so that comparing numbers compares merge priorities
        strings, parts = [*alphabet, END], [None] * 257
        number = {s: i for i, s in enumerate(strings)}
        # a character and the suffix form one symbol before any merge is applied
        joins = [(c, END) for c in alphabet] + [(inner(a), inner(b)) for a, b in merges]
        self.pair: dict[tuple[int, int], int] = {}
        for a, b in joins:
            s, ab = a + b, (number[a], number[b])
            if s not in number:
                number[s] = len(strings)
                strings.append(s)
                parts.append(ab)
            self.pair.setdefault(ab, number[s])
        self.parts = parts
        self.length = [len(s) for s in strings]
        self.ids = [vocab.get(s.replace(END, suffix), -1) for s in strings]

        self._compatible: dict[int, bool] = {}  # left token's number * all tokens + right token's number
        # a token that its own merges never reach must not be proposed
        usable = [p is None or self._reachable(i) for i, p in enumerate(parts)]
        self.automaton = ahocorasick.Automaton()
        for i, s in enumerate(strings):
            if usable[i]:
                self.automaton.add_word(s, i)
        self.automaton.make_automaton()
        self.below: dict[str, int] = {}  # the longest usable token that a path of the trie begins with
        self.shorter = [-1] * len(strings)  # the longest usable proper prefix
        for i, s in enumerate(strings):
            for n in range(len(s) - 1, 0, -1):
                j = number.get(s[:n])
                if j is not None and usable[j]:
                    self.shorter[i] = j
                    break
        for i in sorted((i for i, ok in enumerate(usable) if ok), key=self.length.__getitem__):
            s, best = strings[i], -1
            for n in range(1, len(s)):
                best = self.below.setdefault(s[:n], best)
            self.below[s] = i

        table = [""] * (max([*vocab.values(), *self.special.values()]) + 1)
        for token, i in vocab.items():
            table[i] = token
        for token, i in self.special.items():
            table[i] = token
        raw = [(t + " ").encode() for t in table]
        self.blob = np.frombuffer(b"".join(raw), np.uint8)
        self.size = np.array([len(x) for x in raw], np.int64)
        self.offset = np.concatenate([[0], np.cumsum(self.size)[:-1]])

        self._to_chars = {i: c for i, c in enumerate(alphabet)}
        self._special = re.compile("|".join(sorted(map(re.escape, self.special), key=len, reverse=True)) or r"(?!)")
        # one pattern for texts of code points under each bound: classes without a code point of more
        # than 16 bits are tables, others are searched range by range
        self._splits = []
        for below in (0x80, 0x10000, 0x110000):
            classes = {"{L}": category_class("L", below), "{N}": category_class("N", below), "{S}": WHITE_SPACE}
            self._splits.append(re.compile(re.sub(r"\{[LNS]\}", lambda m: classes[m.group()], SPLIT)))
        self._memo = _Memo(self)

    # -- merges ---------------------------------------------------------------

    def _reachable(self, token: int) -> bool:
        """Whether the merges, applied to the token's own string, give the token."""
        a, b = self.parts[token]
        return self._check(a, b, token)

    def _check(self, left: int, right: int, before: int) -> bool:
        """Whether no merge of number below ``before`` crosses the border of two tokens.

        The token made last is undone first, and its part at the border stays; a pair at
        the border that merges earlier than the parts came to be would have won.
        """
        limit = before
        while True:
            joined = self.pair.get((left, right))
            if joined is not None and joined < limit:
                return False
            if left > right:
                limit, p = left, self.parts[left]
                if p is None:
                    return True
                left = p[1]
            else:
                # at equal priority the left one of two overlapping pairs is merged first
                limit, p = right + 1, self.parts[right]
                if p is None:
                    return True
                right = p[0]

    def compatible(self, left: int, right: int) -> bool:
        key = left * len(self.parts) + right
        known = self._compatible.get(key)
        if known is None:
            known = self._compatible[key] = self._check(left, right, len(self.parts))
            if len(self._compatible) > 2 * MEMO_WORDS:
                self._compatible.clear()
        return known

    def _longest(self, s: str) -> int:
        """The longest usable token that ``s`` begins with."""
        return self.below[s[:self.automaton.longest_prefix(s)]]

    def encode_word(self, word: str) -> list[int]:
        """Ids of one piece of the split (the suffix is added here)."""
        s = "".join(map(self._to_chars.__getitem__, word.encode())) + END
        n = len(s)
        token = self._longest(s)
        if self.length[token] == n:
            return [self.ids[token]]
        alive = bytearray(b"\x01") * (n + 1)
        out: list[int] = []
        at = 0
        length, shorter, known, every = self.length, self.shorter, self._compatible.get, len(self.parts)
        while at < n:
            while token >= 0:
                if alive[at + length[token]]:
                    if not out:
                        break
                    fits = known(out[-1] * every + token)
                    if self.compatible(out[-1], token) if fits is None else fits:
                        break
                token = shorter[token]
            if token >= 0:
                out.append(token)
                at += length[token]
                token = self._longest(s[at:]) if at < n else -1
            else:
                alive[at] = 0
                last = out.pop()
                at -= length[last]
                token = shorter[last]
        return [self.ids[t] for t in out]

    # -- texts ----------------------------------------------------------------

    def _pieces(self, text: str) -> list[str]:
        if text.isascii():
            return self._splits[0].findall(text.lower())
        text = unicodedata.normalize("NFC", text)
        # lower-casing is by character: no special form for a final sigma
        text = text.replace("Σ", "σ").lower()
        return self._splits[1 if max(text) < "\U00010000" else 2].findall(text)

    def encode_bytes(self, text: str | None) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        if not text:
            return b""
        out, at = [], 0
        for m in self._special.finditer(text):
            out += map(self._memo.__getitem__, self._pieces(text[at:m.start()]))
            out.append(self.special[m.group()].to_bytes(4, "little"))
            at = m.end()
        out += map(self._memo.__getitem__, self._pieces(text[at:]))
        if len(self._memo) > MEMO_WORDS // 2:
            self._memo.turn()
        return b"".join(out)

    def encode(self, text: str | None) -> list[int]:
        return np.frombuffer(self.encode_bytes(text), "<u4").tolist()

    def decode_bytes(self, ids: np.ndarray) -> bytes:
        """The decoded text in UTF-8: a gather by the offset table."""
        if not len(ids):
            return b""
        size = self.size[ids]
        ends = np.cumsum(size)
        index = np.arange(ends[-1]) + np.repeat(self.offset[ids] - (ends - size), size)
        return self.blob[index].tobytes()[:-1]  # without the space after the last token


class _Memo(dict):
    """Ids of the words seen, in bytes, in two generations: words used since the last turn survive the next one."""

    def __init__(self, bpe: BacktrackingBpe):
        super().__init__()
        self._bpe = bpe
        self._old: dict[str, bytes] = {}

    def __missing__(self, word: str) -> bytes:
        value = self._old.get(word)
        if value is None:
            ids = self._bpe.encode_word(word)
            value = pack(f"<{len(ids)}I", *ids)
        self[word] = value
        return value

    def turn(self) -> None:
        self._old = dict(self)
        self.clear()


def _bpe_for(model: str) -> BacktrackingBpe:
    """One encoder per worker process and tokenizer."""
    return per_worker(("bpe", hashlib.sha256(model.encode()).hexdigest()), lambda: BacktrackingBpe(model))


def encode_documents(docs: DataFrame, tokenizer_path: str, text: str = "text", with_ids: bool = True) -> DataFrame:
    """Encode a text column and decode the ids again.

    Adds ``ids`` (array of int, if ``with_ids``), ``n_tokens``, ``ids_sha256`` and
    ``decoded_sha256`` to the other columns of ``docs`` (a column of the same name is
    replaced); the text itself is kept.  The tokenizer file, of fixed size, is read by the
    driver and goes to the tasks by a broadcast.
    """
    spark = docs.sparkSession
    with open(tokenizer_path, encoding="utf-8") as f:
        model = spark.sparkContext.broadcast(f.read())
    added = {"ids": "array<int>"} if with_ids else {}
    added |= {"n_tokens": "bigint", "ids_sha256": "string", "decoded_sha256": "string"}
    docs = docs.drop(*added)
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema), *(f"{k} {v}" for k, v in added.items())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = _bpe_for(model.value)
        for batch in in_slices(batches):
            n, ids_sha, text_sha, ids = [], [], [], []
            for t in batch.column(text):
                raw = bpe.encode_bytes(t.as_py())
                arr = np.frombuffer(raw, "<u4")
                n.append(len(arr))
                ids_sha.append(hashlib.sha256(raw).hexdigest())
                text_sha.append(hashlib.sha256(bpe.decode_bytes(arr)).hexdigest())
                if with_ids:
                    ids.append(pa.array(arr.astype(np.int32)))
            extra = [pa.array(n, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(text_sha, pa.string())]
            if with_ids:
                offsets = np.concatenate([[0], np.cumsum(n)]).astype(np.int32)
                values = pa.concat_arrays(ids) if ids else pa.array([], pa.int32())
                extra.insert(0, pa.ListArray.from_arrays(pa.array(offsets), values))
            yield pa.RecordBatch.from_arrays([*batch.columns, *extra], names=[*batch.schema.names, *added])

    return docs.mapInArrow(run, schema)


def bpe_digest(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """The digest columns of the query: doc_id, n_tokens and the two hashes."""
    return encode_documents(pick(docs, "doc_id", "text"), tokenizer_path, with_ids=False).select(
        F.col("doc_id"), F.col("n_tokens"), F.col("ids_sha256"), F.col("decoded_sha256"))
