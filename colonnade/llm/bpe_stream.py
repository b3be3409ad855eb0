"""Operator 12: BPE encoding and decoding as streaming transducers with bounded lookahead.

Encoder.  A sequence of tokens is what the merges make of a text exactly when each neighbouring pair is (``Merges.joins``
looks for a merge across the border that comes before its sides are consumed).  So one token ends the tokenisation of
every prefix, and it follows from shorter prefixes.  The transducer keeps that token for the prefixes of the current
buffer; what comes later can only start within one token's length of the end, so where the tokenisations of those last
prefixes agree, tokens are stable and leave.  ``Merges.lookahead`` is the sufficient lookahead of the merge list: a bound,
computed from the merges, on how far back of the last read symbol a token can still change.  The buffer is at most that
(plus a step), however long a word is.

Text arrives in pieces: special tokens are taken out of the raw text, what is left is normalised up to a character that no later one can change,
and split into words; the last, perhaps unfinished word goes on to the transducer without waiting for its end.  Words are
remembered with their ids in a cache of limited size.

Decoder.  A byte-to-text state machine: ids give bytes, complete characters leave, the started one (3 bytes at most)
stays.  The tokenizer file names no decoder, so its pieces are joined by a blank; ``plain=True`` turns the pieces into
the bytes they stand for instead, word ends into blanks, and broken characters into U+FFFD.

Null text is the empty text, which has no tokens.  Very long texts, words without end included, stream; long sequences of
combining marks alone are held until the next base character, as normalisation reorders them.  Rows with null or repeated
ids are encoded on their own; only ``keep`` columns come along, so others can't clash.  An empty table gives no rows.
"""

from __future__ import annotations

import codecs
import json
import re
import unicodedata
from array import array
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

WORD_END = "</w>"
# The split pattern of the tokenizer file over characters reduced to ASCII classes (see _Classes).
_SPLIT = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zA-Z]+|[0-9]|[^ \t-\ra-zA-Z0-9]+")
_REST_OF = {"q": re.compile("[a-zA-Z]*"), "!": re.compile(r"[^ \t-\ra-zA-Z0-9]*")}
# Below this character Python's Unicode data and the tokenizer's agree (a test compares all); beyond, the file's own
# normaliser and character classes are asked.
_AGREED = "԰"


def byte_alphabet() -> dict[int, str]:
    """The characters that stand for bytes in byte-level vocabularies: printable ones for themselves, others from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    table = {b: chr(b) for b in shown}
    for b in range(256):
        if b not in table:
            table[b] = chr(0x100 + len(table) - len(shown))
    return table


class Merges:
    """Vocabulary and merges, the pair test, and the lookahead the merge list needs."""

    def __init__(self, vocab: dict[str, int], merges: list):
        pairs = [tuple(m) if not isinstance(m, str) else tuple(m.split(" ")) for m in merges]
        self.rank = {(vocab[a], vocab[b]): r for r, (a, b) in enumerate(pairs)}
        self.parts = {vocab[a + b]: (vocab[a], vocab[b]) for a, b in pairs}
        self.size = max(vocab.values()) + 1
        self._known: dict[int, bool] = {}
        self._left: dict[int, list] = {}
        self._right: dict[int, list] = {}
        self.birth = made = {vocab[a + b]: r for r, (a, b) in enumerate(pairs)}
        #: Tokens that the merges make of their own characters; others never occur.
        self.vocab = {}
        sound = set()
        for text, i in sorted(vocab.items(), key=lambda x: made.get(x[1], -1)):
            if i not in made or (self.parts[i][0] in sound and self.parts[i][1] in sound and self._stays(*self.parts[i], made[i])):
                sound.add(i)
                self.vocab[text] = i
        self.width = max(map(len, self.vocab), default=1)
        self.text = {i: t for t, i in vocab.items()}

    def _edge(self, token: int, side: int) -> list:
        """(symbol, rank of the merge that consumes it) along one side of the token's merges, the token itself first."""
        known = (self._left, self._right)[side]
        if token not in known:
            out, death = [], len(self.rank)
            at = token
            while True:
                out.append((at, death))
                if at not in self.parts:
                    break
                death = self.birth[at]
                at = self.parts[at][side]
            known[token] = out
        return known[token]

    def _stays(self, a: int, b: int, before: int) -> bool:
        """No merge across the border of a and b happens before rank ``before``."""
        for x, x_end in self._edge(a, 1):
            for y, y_end in self._edge(b, 0):
                r = self.rank.get((x, y))
                # Of equal merges the leftmost goes first: left of the border it has, right of it not yet.
                if r is not None and r < before and r < x_end and r <= y_end:
                    return False
        return True

    def joins(self, a: int, b: int) -> bool:
        """Whether b may follow a in a tokenisation."""
        key = a * self.size + b
        known = self._known.get(key)
        if known is None:
            if len(self._known) > 1 << 20:
                self._known.clear()
            known = self._known[key] = self._stays(a, b, len(self.rank))
        return known

    def lookahead(self) -> int:
        """Symbols behind which later text can't change a token any more.

        Later text changes whether a symbol next to the end comes to be.  A merge (u, v) whose v is in doubt puts u v and
        u in doubt, len(u) further left, for merges of later ranks only.  One pass in rank order follows every such
        chain; the farthest reach, plus the token that holds it, is the lookahead.
        """
        def length(i: int) -> int:
            t = self.text[i]
            return len(t) - len(WORD_END) + 1 if t.endswith(WORD_END) and len(t) > len(WORD_END) else len(t)

        reach: dict[int, int] = {}
        made = {r: i for i, r in self.birth.items()}
        for (u, v), r in self.rank.items():
            far = max(reach.get(v, 0), length(v)) + length(u)
            for left in (u, made[r]):
                reach[left] = max(reach.get(left, 0), far)
        return max(reach.values(), default=1) + self.width


class WordTransducer:
    """Symbols of one word in, tokens out as soon as they are stable."""

    STEP = 256

    def __init__(self, merges: Merges):
        self.m = merges
        self.unsettled = 0  # most symbols that ever stayed after tokens left
        self.reset()

    def reset(self) -> None:
        self.text = ""        # symbols since the last stable border
        self.back = [(-1, 0)]  # per prefix: its last token, that token's length
        self.check = self.STEP

    def _grow(self, text: str, last: bool) -> None:
        """Extend by ``text``; with ``last`` its final symbol ends the word."""
        vocab, joins, width, back = self.m.vocab, self.m.joins, self.m.width, self.back
        start = len(self.text)
        s = self.text = self.text + text
        n = len(s)
        for i in range(start + 1, n + 1):
            tail = WORD_END if last and i == n else ""
            for size in range(min(i, width), 0, -1):
                t = vocab.get(s[i - size:i] + tail)
                if t is not None:
                    before = back[i - size][0]
                    if before == -1 or joins(before, t):
                        back.append((t, size))
                        break
            else:
                raise ValueError(f"no token for {s[i - 1]!r}")

    def _tokens(self, i: int, stop: int = 0) -> list[int]:
        out = []
        while i > stop:
            t, size = self.back[i]
            out.append(t)
            i -= size
        return out[::-1]

    def feed(self, text: str) -> list[int]:
        """Symbols that do not end the word; returns tokens that became stable."""
        out: list[int] = []
        for at in range(0, len(text), self.STEP):
            self._grow(text[at:at + self.STEP], False)
            if len(self.text) >= self.check:
                out += self._settle()
                self.unsettled = max(self.unsettled, len(self.text))
                self.check = len(self.text) + self.STEP
        return out

    def _settle(self) -> list[int]:
        n = len(self.text)
        ends = {i for i in range(max(0, n - self.m.width + 1), n + 1)}
        while len(ends) > 1:  # walk the farthest end back until all paths meet
            i = max(ends)
            ends.discard(i)
            ends.add(i - self.back[i][1])
        border = ends.pop()
        if border == 0:
            return []
        out = self._tokens(border)
        # The token before the border stays as context of the next one.
        self.back = [(self.back[border][0], 0), *self.back[border + 1:]]
        self.text = self.text[border:]
        return out

    def finish(self, text: str) -> list[int]:
        """The rest of the word (not empty); returns all remaining tokens."""
        self._grow(text, True)
        out = self._tokens(len(self.text))
        self.reset()
        return out


class _Classes(dict):
    """str.translate table to ASCII: letters to q, digits to 0, blanks to a blank, all else to !; asked from the
    tokenizer's own splitter once a character."""

    def __init__(self, splitter):
        super().__init__((c, chr(c)) for c in range(128))
        self.splitter = splitter

    def __missing__(self, c: int) -> str:
        s = chr(c)
        if len(self.splitter.pre_tokenize_str("a" + s + "a")) == 1:
            kind = "q"
        elif len(self.splitter.pre_tokenize_str("!" + s + "!")) == 1:
            kind = "!"
        else:
            kind = "0" if self.splitter.pre_tokenize_str(s) else " "
        self[c] = kind
        return kind


def _may_compose(c: str) -> bool:
    """Whether a character can change what stands before it under composition, or be reordered with it."""
    return unicodedata.combining(c) != 0 or unicodedata.category(c)[0] == "M" or "ᅠ" <= c <= "ᇿ" or c >= "԰" and not unicodedata.is_normalized("NFC", "a" + c)


class Bpe:
    """A word-end BPE tokenizer file: encoder and decoder."""

    def __init__(self, path: str, cache: int = 1 << 20, chunk: int = 1 << 16):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.merges = Merges(spec["model"]["vocab"], spec["model"]["merges"])
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        names = sorted(self.special, key=len, reverse=True)
        self.find_special = re.compile("|".join(map(re.escape, names))) if names else None
        self.longest_special = max(map(len, names), default=0)
        library = Tokenizer.from_file(path)
        self.normalizer, self.classes = library.normalizer, _Classes(library.pre_tokenizer)
        self.alphabet = byte_alphabet()
        self.chunk, self.limit = chunk, cache
        self.cache: dict[str, bytes] = {}
        self.word = WordTransducer(self.merges)
        self.pieces: dict[int, bytes] = {i: t.encode() for i, t in self.merges.text.items()} | {i: t.encode() for t, i in self.special.items()}
        back = {c: b for b, c in self.alphabet.items()}
        self.plain = {}
        for i, t in self.merges.text.items():
            end = t.endswith(WORD_END) and t != WORD_END
            self.plain[i] = bytes(back[c] for c in (t[:-len(WORD_END)] if end else t)) + (b" " if end else b"")
        self.plain |= {i: t.encode() for t, i in self.special.items()}

    def symbols(self, word: str) -> str:
        return word.encode("utf-8", "surrogatepass").decode("latin-1").translate(self.alphabet)

    def _word(self, word: str) -> bytes:
        got = array("I", self.word.finish(self.symbols(word))).tobytes()
        if len(word) <= 64:
            if len(self.cache) >= self.limit:
                self.cache.clear()
            self.cache[word] = got
        return got

    def normalise(self, text: str) -> str:
        if text.isascii():
            return text.lower()
        if max(text) < _AGREED:
            # Lower case is taken by character: a final sigma is not special.
            return unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()
        return self.normalizer.normalize_str(text)

    def encode(self, pieces: Iterable[str]) -> Iterator[bytes]:
        """Ids (unsigned 32 bit, little-endian) of the text that the pieces make together, as they become stable."""
        raw = ""
        run = _Run(self)
        for piece in pieces:
            raw += piece
            while self.find_special and (hit := self.find_special.search(raw)):
                yield from run.feed(raw[:hit.start()])
                yield from run.finish()
                yield array("I", [self.special[hit.group()]]).tobytes()
                raw = raw[hit.end():]
            # A special token may have begun at the end.
            at = raw.rfind("<", max(0, len(raw) - self.longest_special + 1)) if self.special else -1
            cut = len(raw)
            while at >= 0 and any(s.startswith(raw[at:]) for s in self.special):
                cut = at
                at = raw.rfind("<", max(0, len(raw) - self.longest_special + 1), at)
            yield from run.feed(raw[:cut])
            raw = raw[cut:]
        yield from run.feed(raw)
        yield from run.finish()

    def encode_text(self, text: str | None) -> bytes:
        text = text or ""
        return b"".join(self.encode(text[i:i + self.chunk] for i in range(0, len(text), self.chunk)))

    def decode(self, chunks: Iterable[bytes], plain: bool = False) -> Iterator[str]:
        """Text of the ids, by chunks of ids."""
        table = self.plain if plain else self.pieces
        machine = codecs.getincrementaldecoder("utf-8")("replace")
        begun = False
        for chunk in chunks:
            ids = array("I", chunk)
            if not ids:
                continue
            got = (b"" if plain else b" ").join(map(table.__getitem__, ids))
            yield machine.decode(got if plain or not begun else b" " + got)
            begun = True
        yield machine.decode(b"", True)


class _Run:
    """A stretch without special tokens: normalisation, words and the transducer, with what each has not settled."""

    def __init__(self, bpe: Bpe):
        self.b = bpe
        self.raw = ""      # not normalised yet
        self.norm = ""     # normalised, not split yet
        self.kind = None   # class of the unfinished word in the transducer
        self.held = ""     # its last symbols, as the last one may end the word

    def feed(self, text: str) -> Iterator[bytes]:
        raw = self.raw + text
        cut = len(raw)
        # The last character may compose with what comes; go back to one that begins afresh.
        while cut > 0 and _may_compose(raw[cut - 1]):
            cut -= 1
        cut = max(0, cut - 1)
        self.raw = raw[cut:]
        yield from self._split(self.b.normalise(raw[:cut]), False)

    def finish(self) -> Iterator[bytes]:
        rest, self.raw = self.raw, ""
        yield from self._split(self.b.normalise(rest), True)

    def _split(self, text: str, last: bool) -> Iterator[bytes]:
        norm = self.norm + text
        flat = norm if norm.isascii() else norm.translate(self.b.classes)
        at = 0
        if self.kind:  # the unfinished word first
            at = _REST_OF[self.kind].match(flat).end()
            self.held += self.b.symbols(norm[:at])
            if at < len(flat) or last:
                yield array("I", self.b.word.finish(self.held)).tobytes()
                self.kind, self.held = None, ""
            elif len(self.held) > 1:
                yield array("I", self.b.word.feed(self.held[:-1])).tobytes()
                self.held = self.held[-1:]
        spans = [m.span() for m in _SPLIT.finditer(flat, at)]
        rest = len(norm)
        # Later text may lengthen the last word, and turn an apostrophe before it into a contraction.
        while not last and spans and spans[-1][1] == rest and (rest == len(norm) or len(norm) - spans[-1][0] <= 3):
            rest = spans.pop()[0]
        cache, out = self.b.cache, []
        for s, e in spans:
            w = norm[s:e]
            out.append(cache.get(w) or self.b._word(w))
        if out:
            yield b"".join(out)
        self.norm = norm[rest:]
        if not last and len(self.norm) > 64 and self.kind is None:
            self.kind = "q" if flat[rest].isalpha() else "!"
            body, self.norm = self.norm, ""
            symbols = self.b.symbols(body)
            yield array("I", self.b.word.feed(symbols[:-1])).tobytes()
            self.held = symbols[-1:]


_LOADED: dict[str, Bpe] = {}


def load(path: str) -> Bpe:
    """One tokenizer per worker process and file."""
    if path not in _LOADED:
        _LOADED[path] = Bpe(path)
    return _LOADED[path]


def encode_documents(docs: DataFrame, path: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",), batch_bytes: int = 4 << 20) -> DataFrame:
    """``keep`` columns, n_tokens, ids (binary, unsigned 32 bit little-endian) and decoded (string) of every text."""
    rows = docs.select(*[F.col(c) for c in keep], F.col(text).alias("_text"))
    schema = T.StructType([*rows.schema.fields[:-1], T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.BinaryType()), T.StructField("decoded", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path)
        for b in batches:
            start, size, ids, said = 0, 0, [], []
            column = b.column(len(b.schema.names) - 1)
            for i in range(b.num_rows):
                got = bpe.encode_text(column[i].as_py())
                ids.append(got)
                said.append("".join(bpe.decode(got[k:k + bpe.chunk] for k in range(0, len(got), bpe.chunk))))
                size += 3 * len(got)
                if size > batch_bytes or i == b.num_rows - 1:
                    kept = [c.slice(start, len(ids)) for c in b.columns[:-1]]
                    new = [pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary()), pa.array(said, pa.string())]
                    yield pa.RecordBatch.from_arrays([*kept, *new], names=schema.names)
                    start, size, ids, said = i + 1, 0, [], []
    return rows.mapInArrow(run, schema)
