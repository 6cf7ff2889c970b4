"""Operator 3, BPE encoding and decoding over a trie of distinct words.

The distinct words of a batch make a trie, held as their sorted list. A depth-first walk keeps, for each
prefix on the path, the last token of the prefix's encoding; the encoding of a
longer prefix is the encoding of a shorter one plus a token that may stand after
that one's last token, so what words share is encoded once. A text is then a list
of look-ups. Nothing is shuffled: each task walks its own tries, with memory
bounded by a stretch of texts and a limited cache of encodings: a worker lives on beside
others and an executor whose heap earlier stages have filled.

Normalisation and the splitting into words are those of the tokenizer file; the
vocabulary is broadcast as the file's text, so executors need no file.
"""

from __future__ import annotations

import hashlib
import json
import re
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession

from carelens.llm.common import carrying, give_back, mapped

#: Encodings that a worker keeps in each of two generations: when the younger is full,
#: it becomes the older, whose unused encodings are then dropped. Most words stand in one
#: stretch of texts only; they are kept from the second on, which ``SEEN`` bytes tell.
CACHED, SEEN = 50_000, 1 << 21
#: Texts whose distinct words make one trie, and their code points unless one text has more.
TEXTS, CHARS = 1000, 1_000_000
#: Pairs of tokens of which a worker keeps whether one may follow the other.
PAIRS = 150_000
#: The kind of number that ids are kept as, to ``array`` and to numpy.
ID = "I"
#: Longer pieces between white space are encoded, but not kept.
CACHED_CHARS = 64
#: Pieces that a normaliser to NFC and lower case leaves as they are but for case,
#: and that are split into letters and what follows them in the one way.
PLAIN = re.compile(r"([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f]+)([!-&(-/:-@\[-`{-~]*)")


def byte_alphabet() -> dict[str, int]:
    """The characters that byte-level vocabularies write bytes as: printable
    Latin-1 stands for itself, the other bytes for 256, 257 and so on, in order."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


def plain_pieces(found: dict) -> bool:
    """Whether the file normalises and splits plain pieces as ``PLAIN`` does."""
    kinds = [n["type"] for n in (found.get("normalizer") or {}).get("normalizers", [])]
    cuts = (found.get("pre_tokenizer") or {}).get("pretokenizers", [])
    letters = r"[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
    return kinds == ["NFC", "Replace", "Lowercase"] and bool(found["model"].get("end_of_word_suffix")) and len(cuts) == 2 and (
        cuts[0].get("pattern", {}).get("Regex", "").endswith(letters) and cuts[1]["type"] == "ByteLevel")


def used_again(new: set[str], kept: dict, before: dict) -> set[str]:
    """Moves what ``before`` knows of ``new`` to ``kept``; the rest is returned."""
    known = new & before.keys()
    for word in known:
        kept[word] = before[word]
    return new - known


def stretches(texts: list[str]) -> Iterator[list[str]]:
    """The texts in order, in stretches of ``TEXTS`` texts and ``CHARS`` code points at
    most; a longer text is a stretch of its own."""
    start, size = 0, 0
    for at, text in enumerate(texts):
        if at > start and (at - start >= TEXTS or size + len(text) > CHARS):
            yield texts[start:at]
            start, size = at, 0
        size += len(text)
    if texts:
        yield texts[start:]


class Seen:
    """Words that came before, as marks at their hashes: now and then a new one is taken
    for one of them. The marks start anew when a quarter of them is set."""

    def __init__(self):
        self.marks, self.n = bytearray(SEEN), 0

    def new(self, words: Iterable[str]) -> list[str]:
        """Those that didn't come before; from now on they did."""
        marks, mask = self.marks, len(self.marks) - 1
        found = []
        for word in words:
            at = hash(word) & mask
            if not marks[at]:
                marks[at] = 1
                found.append(word)
        self.n += len(found)
        if self.n * 4 > len(marks):
            self.__init__()
        return found


class TrieEncoder:
    """BPE over symbols: a byte, or 256 plus a byte where it ends a word."""

    def __init__(self, model: str):
        from tokenizers import Tokenizer

        found = json.loads(model)
        bpe, alphabet = found["model"], byte_alphabet()
        self.end = bpe.get("end_of_word_suffix") or ""
        self.library = Tokenizer.from_str(model)
        self.alphabet = alphabet
        self.names = {i: t for t, i in bpe["vocab"].items()}
        self.special = {t["content"]: t["id"] for t in found.get("added_tokens", [])}
        self.names |= {i: t for t, i in self.special.items()}
        # by id; what is kept of a word are its ids as 32-bit numbers, which cost less than strings
        self.decimals, self.spellings = np.empty((2, max(self.names, default=0) + 1), dtype=object)
        for i, name in self.names.items():
            self.decimals[i], self.spellings[i] = str(i), name
        self.plain = plain_pieces(found)
        self.cut = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.spelled: dict[str, int] = {}
        for token, i in bpe["vocab"].items():
            ends = bool(self.end) and token.endswith(self.end) and token != self.end
            body = token[: -len(self.end)] if ends else token
            if all(c in alphabet for c in body):
                codes = [alphabet[c] for c in body]
                if ends:
                    codes[-1] += 256
                self.spelled["".join(map(chr, codes))] = i
        self.longest = max(map(len, self.spelled), default=1)
        self.rank: dict[tuple[int, int], int] = {}
        self.parts: dict[int, tuple[int, int, int]] = {}
        for rank, (a, b) in enumerate(bpe["merges"]):
            left, right, made = bpe["vocab"][a], bpe["vocab"][b], bpe["vocab"][a + b]
            self.rank.setdefault((left, right), rank)
            self.parts.setdefault(made, (rank, left, right))
        self.whole: dict[int, bool] = {}
        self.follows: dict[tuple[int, int], bool] = {}
        # of pieces between white space, and of plain words; each younger and older
        self.kept: dict[str, bytes] = {}
        self.kept_before: dict[str, bytes] = {}
        self.words: dict[str, bytes] = {}
        self.words_before: dict[str, bytes] = {}
        self.seen, self.seen_words = Seen(), Seen()

    def _edge(self, token: int, until: float, side: int) -> list[tuple[int, float]]:
        """The pieces that stand at a token's left (1) or right (2) edge while it
        is put together, each with the rank of the merge that consumes it."""
        found = [(token, until)]
        while token in self.parts:
            until, token = self.parts[token][0], self.parts[token][side + 0]
            found.append((token, until))
        return found

    def _apart(self, a: int, b: int, until: float) -> bool:
        """Whether no merge across the border of a and b comes before the merges
        that put a and b together, or before ``until``. Of equal merges the left
        one comes first."""
        for x, x_gone in self._edge(a, until, 2):
            for y, y_gone in self._edge(b, until, 1):
                rank = self.rank.get((x, y))
                if rank is not None and rank < x_gone and rank <= y_gone and not (x == a and y == b and rank == until):
                    return False
        return True

    def _is_whole(self, token: int) -> bool:
        """Whether the token's own spelling is encoded as this one token."""
        known = self.whole.get(token)
        if known is None:
            known = True
            if token in self.parts:
                rank, a, b = self.parts[token]
                known = self._is_whole(a) and self._is_whole(b) and self._apart(a, b, rank)
            self.whole[token] = known
        return known

    def _may_follow(self, a: int, b: int) -> bool:
        known = self.follows.get((a, b))
        if known is None:
            if len(self.follows) >= PAIRS:
                self.follows.clear()
            known = self.follows[a, b] = self._apart(a, b, float("inf"))
        return known

    def encode_words(self, words: Iterable[str]) -> dict[str, list[int]]:
        """The ids of each distinct word, given as symbols.

        The trie is held as the sorted list of its words: next to each other they share
        the upper part of their paths, and walking down the list is walking the trie
        depth first, without a table for each node."""
        spelled, longest, whole, follows = self.spelled, self.longest, self.whole, self.follows
        last, size = [-1], [0]  # of each prefix on the path the last token, and its length in symbols
        out: dict[str, list[int]] = {}
        before = ""
        for word in sorted(words):
            depth = 0
            for a, b in zip(before, word, strict=False):
                if a != b:
                    break
                depth += 1
            before = word
            del last[depth + 1 :], size[depth + 1 :]
            while depth < len(word):
                # exactly one token may end a prefix: the last one longer by a symbol,
                # a symbol of its own, or one of another length
                n = size[depth] + 1
                depth += 1
                token = spelled.get(word[depth - n : depth])
                above = last[depth - n]
                if token is None or not (whole.get(token) or self._is_whole(token)) or not (
                        above < 0 or follows.get((above, token)) or self._may_follow(above, token)):
                    for n in range(1, min(depth, longest) + 1):
                        token = spelled.get(word[depth - n : depth])
                        if token is not None and self._ends(token, last[depth - n], whole, follows):
                            break
                    else:
                        raise ValueError(f"the vocabulary can't spell {word[max(depth - longest, 0) : depth]!r}")
                last.append(token)
                size.append(n)
            ids, at = [], depth
            while at:
                ids.append(last[at])
                at -= size[at]
            out[word] = ids[::-1]
        return out

    def _ends(self, token: int, before: int, whole: dict, follows: dict) -> bool:
        """Whether the token may stand after the prefix whose last token is ``before``."""
        if not (whole.get(token) or self._is_whole(token)):
            return False
        return before < 0 or follows.get((before, token)) or self._may_follow(before, token)

    def _words(self, piece: str) -> list[str | int]:
        """Words, as symbols, and ids of special tokens, of a piece of text."""
        found: list[str | int] = []
        for part in self.cut.split(piece) if self.cut else [piece]:
            if part in self.special:
                found.append(self.special[part])
                continue
            if not part:
                continue
            if self.library.normalizer:
                part = self.library.normalizer.normalize_str(part)
            for word, _ in self.library.pre_tokenizer.pre_tokenize_str(part):
                codes = [self.alphabet[c] for c in word]
                if codes:
                    found.append("".join(map(chr, codes[:-1])) + chr(codes[-1] + 256 * bool(self.end)))
        return found

    def encode_pieces(self, pieces: Iterable[str]) -> dict[str, bytes]:
        """For each piece its ids, as 32-bit numbers. Plain pieces are a word and the signs
        after it, told from the cache."""
        plain, other = {}, {}
        for piece in pieces:
            if self.plain and (m := PLAIN.fullmatch(piece)):
                plain[piece] = (m[1].lower(), m[2])
            else:
                other[piece] = self._words(piece)
        if len(self.words) > CACHED:
            self.words_before, self.words = self.words, {}
        new = {w for ws in plain.values() for w in ws if w} - self.words.keys()
        new = used_again(new, self.words, self.words_before)
        as_symbols = {}
        for word in new:
            code = word.encode()
            as_symbols[word] = code[:-1].decode("latin-1") + chr(256 + code[-1])
        known = self.encode_words({*as_symbols.values(), *(w for ws in other.values() for w in ws if isinstance(w, str))})
        for word, symbols in as_symbols.items():
            self.words[word] = array(ID, known[symbols]).tobytes()
        out = {}
        for piece, (word, signs) in plain.items():
            out[piece] = self.words[word] + self.words[signs] if signs else self.words[word]
        for piece, words in other.items():
            out[piece] = array(ID, [i for w in words for i in ([w] if isinstance(w, int) else known[w])]).tobytes()
        for word in self.seen_words.new(as_symbols):
            del self.words[word]
        return out

    def decode(self, ids: Iterable[int]) -> str:
        """The tokens' names, joined by a space, as for a file without a decoder."""
        return " ".join([self.names[i] for i in ids])

    def encode_texts(self, texts: list[str]) -> Iterator[tuple[str, str, int]]:
        """Ids, decoded text and number of ids of each text. No word, and nothing
        that normalisation joins, crosses an ASCII space or line end, so a text is
        the sequence of the pieces between them."""
        for some in stretches(texts):
            yield from self._encode_some([re.split("[ \t\r\n]+", t) for t in some])

    def _encode_some(self, pieces: list[list[str]]) -> Iterator[tuple[str, str, int]]:
        if len(self.kept) > CACHED:
            self.kept_before, self.kept = self.kept, {}
        self.kept.setdefault("", b"")
        new = used_again(set().union(*pieces) - self.kept.keys(), self.kept, self.kept_before)
        self.kept |= self.encode_pieces(new)
        long = {p for p in new if len(p) > CACHED_CHARS}
        kept = self.kept
        for found in pieces:
            ids = np.frombuffer(b"".join([kept[p] for p in found]), dtype=ID)
            yield " ".join(self.decimals[ids].tolist()), " ".join(self.spellings[ids].tolist()), len(ids)
        for piece in [*long, *self.seen.new(new - long)]:
            del self.kept[piece]


def vocabulary(spark: SparkSession, path: str):
    """The tokenizer file, broadcast: its size is that of one vocabulary."""
    with open(path, encoding="utf-8") as f:
        return spark.sparkContext.broadcast({"model": f.read()})


def encoder_of(shared: dict) -> TrieEncoder:
    """The encoder of a broadcast vocabulary, made once in each Python worker, so
    that tasks in one worker share what it keeps."""
    if "encoder" not in shared:
        shared["encoder"] = TrieEncoder(shared["model"])
        give_back()  # what reading the file took
    return shared["encoder"]


def encode(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """``row`` (the input row without its text) with ids (the decimal ids joined by a
    space), n_tokens and decoded of every document. Null and empty texts have no ids.
    Special tokens that stand in a text are encoded as such. Repeated rows each come
    back."""
    model = vocabulary(docs.sparkSession, path)

    def make():
        encoder = encoder_of(model.value)

        def run(texts: list[str]):
            found = list(encoder.encode_texts(texts))
            return [x[0] for x in found], [x[2] for x in found], [x[1] for x in found]

        return run

    rows = carrying(docs, [c for c in docs.columns if c != text], text)
    return mapped(rows, make, {"ids": "string", "n_tokens": "bigint", "decoded": "string"}, TEXTS)


def encode_digest(docs: DataFrame, path: str) -> DataFrame:
    """Per document: doc_id, n_tokens and the hashes of ids and decoded text, made
    in the task so that neither leaves it."""
    model = vocabulary(docs.sparkSession, path)

    def make():
        encoder = encoder_of(model.value)

        def run(texts: list[str]):
            found = [
                (n, hashlib.sha256(ids.encode()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest())
                for ids, decoded, n in encoder.encode_texts(texts)]
            return zip(*found, strict=True)

        return run

    told = mapped(carrying(docs, ["doc_id"], "text"), make, {
        "n_tokens": "bigint", "ids_sha256": "string", "decoded_sha256": "string"}, TEXTS)
    return told.select("row.doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
