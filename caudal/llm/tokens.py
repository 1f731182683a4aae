"""Token ids of whole texts, shared by the binary output (1) and packing (8).

Ids come from the ``tokenizers`` library. A tokenizer whose normaliser and pre-tokeniser never join two sides of white
space gives a text the ids of its words in order. A word of ASCII and Latin letters is made of pre-tokens (runs of
letters, digits, runs of the rest) that have their ids alone, so a text is cut into words, each distinct one is cut into
pre-tokens and encoded once, and its ids are reused; runs of letters go straight to the model, past the normaliser and the
pre-tokeniser's pattern. Everything in which this could matter (a special token's bracket, combining marks, apostrophes,
other scripts) is encoded as it stands. ``tests/llm`` compares both ways.
"""

from __future__ import annotations

import re
import struct

import numpy as np

from caudal.llm.common import kept_by_worker

TOKENIZER_FILE = "word_bpe_49k.json"
VOCAB_SIZE = 49_408
END_ID = 1
#: Words whose ids a Python worker keeps in each of two generations (about 150 bytes each), and the bytes of the longest that
#: stays after its batch; a reused worker keeps them.
MAX_WORDS, LONG = 300_000, 64
#: Texts, and their bytes, that are encoded together.
BATCH_TEXTS, BATCH_BYTES = 1024, 4 << 20
#: Pre-tokens that one call of the tokenizer encodes: its tokens and offsets take far more memory than their ids.
ENCODED = 8192

_LETTERS = "a-zß-öø-įı-ſ"  # without the one letter whose lower case is two characters
_PLAIN = re.compile(f"[!-&(-~{_LETTERS}]+")  # ASCII but the apostrophe, and Latin letters
_WORD_PARTS = re.compile(f"[{_LETTERS}]+|[0-9]|[^0-9{_LETTERS}]+")

#: Marks after a small letter, at the end of its word: a pre-token by themselves.
_MARKS = re.compile(rb"[!-&(-/:-@[-`{-~](?<=[a-z].)[!-&(-/:-@[-`{-~]*+(?![^ \t-\r])")
_BLANK, _SMALL, _ODD = r" \t-\r", "a-zß-öø-ÿ", "'\x80-\xde÷\u0100-\U0010ffff"
_RUN = re.compile(f"[{_SMALL}]+")
_HAS_ODD = re.compile(f"[{_ODD}]")
#: Pre-tokens of a text in small letters of ASCII and Latin-1; with odd characters, a word that holds one stays whole.
_PRE_TOKENS = re.compile(f"[{_SMALL}]+|[0-9]|[^0-9{_SMALL}{_BLANK}]+")
_MIXED_PRE_TOKENS = re.compile(f"[^{_BLANK}{_ODD}]*+[{_ODD}][^{_BLANK}]*|[{_SMALL}]+|[0-9]|[^0-9{_SMALL}{_BLANK}{_ODD}]+")


def tokenizer_path(name: str = TOKENIZER_FILE) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class Encoder:
    """``encode(texts)``: for each UTF-8 text the ids as little-endian unsigned 32-bit integers.

    ``by_word`` needs a tokenizer that lower-cases, drops white space and splits as said above; without it every text
    is encoded whole.
    """

    def __init__(self, path: str, by_word: bool = True):
        from tokenizers import Tokenizer

        self.tokenizer, self.by_word = Tokenizer.from_file(path), by_word
        self.model = Runs(self.tokenizer)
        self.ids: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}

    @classmethod
    def of_worker(cls, path: str, by_word: bool = True) -> Encoder:
        """One encoder for tasks that reuse a worker, until it turns to other work: they reuse its words."""
        return kept_by_worker((path, by_word), lambda: cls(path, by_word))

    def whole(self, text: bytes) -> bytes:
        return np.array(self.tokenizer.encode(text.decode(), add_special_tokens=False).ids, "<u4").tobytes()

    def encode(self, texts: list[bytes]) -> list[bytes]:
        plain = [self.by_word and not (b"<|" in t or b"\xcc" in t or b"\xcd" in t) for t in texts]
        lists = [_words(t) if p else [] for t, p in zip(texts, plain)]
        long = self._learn(set().union(*lists))
        get = self.ids.__getitem__
        out = [b"".join(map(get, ws)) if p else self.whole(t) for t, p, ws in zip(texts, plain, lists)]
        for w in long:
            del self.ids[w]
        return out

    def _learn(self, words: set[bytes]) -> list[bytes]:
        """Ids of all these words; returns those that are too long to be kept."""
        if len(self.ids) >= MAX_WORDS:
            self.ids, self.older = {}, self.ids
        ids = self.ids
        new = words.difference(ids)
        if self.older:
            again = new.intersection(self.older)
            ids.update((w, self.older[w]) for w in again)
            new -= again
        runs, others, parts = [], [], {}
        for w in new:
            text = w.decode()
            if w.isalpha() or _RUN.fullmatch(text):
                runs.append(text)
            else:
                parts[w] = [p.encode() for t in _pre_tokens(text) for p in _split(t)]
        todo = set().union(*parts.values()).difference(ids, new.difference(parts))
        for p in todo:
            text = p.decode()
            (runs if _is_run(text) else others).append(text)
        self._add_runs(runs)
        self._add_others(others)
        for w, p in parts.items():
            if w not in ids:
                ids[w] = b"".join([ids[x] for x in p])
        return [w for w in new | todo if len(w) > LONG]

    def _add_runs(self, runs: list[str]) -> None:
        for i in range(0, len(runs), ENCODED):
            some = runs[i : i + ENCODED]
            self.ids.update(zip(map(str.encode, some), self.model.encode(some)))

    def _add_others(self, words: list[str]) -> None:
        for i in range(0, len(words), ENCODED):
            some = words[i : i + ENCODED]
            encoding = self.tokenizer.encode(" ".join(some), add_special_tokens=False)
            at = np.fromiter((o[0] for o in encoding.offsets), np.int64, len(encoding.offsets))
            lengths = np.fromiter(map(len, some), np.int64, len(some))
            self._cut(some, encoding.ids, np.searchsorted(at, np.cumsum(lengths + 1) - lengths - 1))

    def _cut(self, words: list[str], ids: list[int], starts: np.ndarray) -> None:
        raw, cut = np.array(ids, "<u4").tobytes(), (starts * 4).tolist()
        self.ids.update(zip(map(str.encode, words), [raw[i:j] for i, j in zip(cut, [*cut[1:], len(raw)])]))


class Runs:
    """``encode(runs)``: the ids of runs of letters by a tokenizer's model alone, each as if a pre-token of a text."""

    def __init__(self, tokenizer):
        from tokenizers import pre_tokenizers

        level = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.tokenize = tokenizer.model.tokenize
        self.letters = {c: level.pre_tokenize_str(chr(c))[0][0] for c in range(0xDF, 0x180)}  # ASCII letters stay as they are

    def encode(self, runs: list[str]) -> list[bytes]:
        out = []
        for run in runs:
            ids = [t.id for t in self.tokenize(run if run.isascii() else run.translate(self.letters))]
            out.append(struct.pack(f"<{len(ids)}I", *ids))
        return out


def _is_run(word: str) -> bool:
    """A run of letters, as ``_split`` makes them: it has no other character if it has one letter."""
    return word.isalpha() and _PLAIN.fullmatch(word) is not None


def _words(text: bytes) -> list[bytes]:
    """Words of a text, A-Z in lower case; marks at the end of a word are one of their own."""
    return _MARKS.sub(rb" \g<0>", text.lower()).split()


def _pre_tokens(text: str) -> list[str]:
    """Pre-tokens of a text (A-Z in lower case); words with an apostrophe, or a character beyond ASCII and small Latin-1
    letters, stay whole."""
    return (_MIXED_PRE_TOKENS if _HAS_ODD.search(text) else _PRE_TOKENS).findall(text)


def _split(word: str) -> list[str]:
    """What ``_pre_tokens`` left whole, cut where its ids are those of its pre-tokens."""
    s = word.lower()
    return [word] if word.isascii() or _PLAIN.fullmatch(s) is None else _WORD_PARTS.findall(s)


def batches(rows, text_of):
    """Rows in lists of at most BATCH_TEXTS rows and about BATCH_BYTES of text."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += len(text_of(row))
        if len(held) >= BATCH_TEXTS or size >= BATCH_BYTES:
            yield held
            held, size = [], 0
    if held:
        yield held
