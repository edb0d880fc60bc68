"""Token ids of many texts with the ``tokenizers`` library.

A text is cut before each space, which no token of the two vocabularies crosses, and every different
word is encoded once per worker. Texts where a cut could change a run of white space, and those that hold the string
of an added token, are encoded whole. Latin text is cut into words and symbols where the vocabulary itself does so, which
leaves fewer different words; case and white space are dropped from them if the vocabulary drops them.
"""

from __future__ import annotations

import json
import os
import re
import unicodedata
from array import array
from itertools import chain, repeat

import numpy as np
from tokenizers import Tokenizer, pre_tokenizers

#: A space with white space, or the end, behind it and white space before it.
_UNSAFE = re.compile(r"\s (?:\s|\Z)")
_SEPARATOR = " |"
#: Words joined into one string for a call; their ids are told apart by the space that a token begins with, or by the
#: separator's where the vocabulary drops spaces.
_JOINED = 64
#: A vocabulary's cut into words, numbers and symbols, as its file has it, and the normalizers it follows.
_CUT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_NORMALIZERS = ["NFC", "Replace", "Lowercase"]
#: Characters that NFC leaves alone and that are in lower case, letters and numbers alike to Python and the library.
_LATIN = [chr(c) for c in (*range(0x21, 0x7F), *range(0xA1, 0x180)) if c != 0x130]
_PLAIN = re.compile(f"[\\t\\n\\r {re.escape(''.join(_LATIN))}\u2010-\u2027\u2030-\u205e]*")


def _class(kind: str) -> str:
    """The Latin letters (L) or numbers (N) as ranges of a pattern."""
    own = [ord(c) for c in _LATIN if unicodedata.category(c)[0] == kind]
    first, last = set(own) - {c + 1 for c in own}, set(own) - {c - 1 for c in own}
    return "".join(f"\\u{a:04x}-\\u{b:04x}" for a, b in zip(sorted(first), sorted(last)))


#: The cut for Latin text in lower case: letters first, as most pieces are.
_PIECE = re.compile("[L]+|'(?:[stmd]|re|ve|ll)|[N]|[^\\sLN]+".replace("L", _class("L")).replace("N", _class("N")))
#: The cut of byte-level vocabularies for Latin text: a piece has the space before it, if any.
_SPACED = " ?[L]+|'(?:[stmd]|re|ve|ll)| ?[N]+| ?[^\\sLN]+|\\s+(?!\\S)|\\s+"
_SPACED_PIECE = re.compile(_SPACED.replace("L", _class("L")).replace("N", _class("N")))
#: A word with the space before it.
_WORD = re.compile(" [^ ]*")


class WordEncoder:
    """Encodes batches of texts and appends ``end_id`` to each; the cache is bounded by ``max_words``."""

    def __init__(self, path: str, end_id: int, max_words: int = 1_200_000):
        # Spark's tasks fill the cores; threads of one task would only wait for each other.
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self._tokenizer = Tokenizer.from_file(path)
        # The strings of added tokens are found anywhere in a text, some before and some after it is normalised.
        added = [token.content for token in self._tokenizer.get_added_tokens_decoder().values()]
        self._begins = {re.match(r"[^a-zA-Z]*", content)[0] for content in added}
        self._added = re.compile("|".join(map(re.escape, added)) or r"(?!)", re.IGNORECASE)
        separator = self._tokenizer.encode(_SEPARATOR, add_special_tokens=False).ids
        if len(separator) != 1:
            raise ValueError("the vocabulary has no single token for the separator")
        self._separator, self._end, self._max = separator[0], end_id, max_words
        names = self._tokenizer.get_vocab()
        self._pieces = self._cutter()
        self._closing = np.zeros(max(names.values()) + 1, bool)
        self._closing[[number for name, number in names.items() if name.endswith("</w>")]] = True
        self._reset()
        self._drops_newlines = len({self._encode([text])[0].tobytes() for text in ("a\nb", "a b")}) == 1
        # Byte-level vocabularies mark the tokens that begin with a space, so words after spaces need no separator.
        # One that drops spaces may hold the mark all the same, as the character of a byte.
        self._spaced = np.zeros(max(names.values()) + 1, bool)
        if len({self._encode([text])[0].tobytes() for text in (" a", "a")}) > 1:
            self._spaced[[number for name, number in names.items() if name.startswith("\u0120")]] = True
        self._keeps_spaces = bool(self._spaced.any())  # then words are remembered with the space before them
        self._cuts_spaced = self._keeps_spaces and self._byte_level()

    def _byte_level(self) -> bool:
        """Whether texts are not normalised and are cut as byte-level vocabularies do by default."""
        own = json.loads(self._tokenizer.to_str())
        cut = own["pre_tokenizer"] or {}
        default = cut.get("type") == "ByteLevel" and cut.get("use_regex", True) and not cut.get("add_prefix_space", True)
        return default and own["normalizer"] is None

    def _cutter(self) -> Tokenizer | None:
        """The vocabulary without what cuts and normalises a text, if that is the cut into pieces; takes them parted by spaces."""
        own = json.loads(self._tokenizer.to_str())
        normalizers = [step["type"] for step in (own["normalizer"] or {}).get("normalizers", [])]
        cuts = (own["pre_tokenizer"] or {}).get("pretokenizers", [{}])
        if normalizers != _NORMALIZERS or cuts[0].get("pattern") != {"Regex": _CUT} or own["model"].get("end_of_word_suffix") != "</w>":
            return None
        bare = Tokenizer(self._tokenizer.model)
        symbols = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        bare.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.CharDelimiterSplit(" "), symbols])
        return bare

    def _reset(self) -> None:
        self._index: dict[str, int] = {}
        self._ids, self._starts, self._lengths = array("I"), array("q"), array("q")
        self._add(np.array([self._end], np.uint32), np.ones(1, np.int64))

    def _add(self, ids: np.ndarray, lengths: np.ndarray) -> range:
        """Remember runs of ids and return their numbers."""
        first, begin = len(self._starts), len(self._ids)
        self._starts.frombytes((begin + np.cumsum(lengths) - lengths).astype(np.int64).tobytes())
        self._lengths.frombytes(lengths.astype(np.int64).tobytes())
        self._ids.frombytes(ids.astype(np.uint32).tobytes())
        return range(first, first + len(lengths))

    def _encode(self, texts: list[str], tokenizer: Tokenizer | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Ids of texts one after the other, and each one's number of ids."""
        found = [x.ids for x in (tokenizer or self._tokenizer).encode_batch_fast(texts, add_special_tokens=False)]
        return np.fromiter(chain.from_iterable(found), np.uint32), np.fromiter(map(len, found), np.int64, len(found))

    def _learnt(self, plain: list[str]) -> range:
        """Remember the ids of words that follow a space and can be joined, and return their numbers."""
        runs = [plain[i : i + _JOINED] for i in range(0, len(plain), _JOINED)]
        if self._keeps_spaces:
            ids, _ = self._encode([f" {' '.join(run)}" for run in runs])
            begins = np.flatnonzero(self._spaced[ids])
            if len(begins) == len(plain):
                return self._add(ids, np.diff(begins, append=len(ids)))
            return self._add(*self._encode([" " + w for w in plain]))
        ids, _ = self._encode([f" {(_SEPARATOR + ' ').join(run)}{_SEPARATOR}" for run in runs])
        ends = np.flatnonzero(ids == self._separator)
        return self._add(ids[ids != self._separator], np.diff(ends, prepend=-1) - 1)

    def _learn(self, new: list[str]) -> None:
        """Remember the ids of words that follow a space."""
        if self._pieces:
            cut = [w for w in new if _PIECE.fullmatch(w) and _PLAIN.fullmatch(w) and w == w.lower()]
            runs = [" ".join(cut[i : i + _JOINED]) for i in range(0, len(cut), _JOINED)]
            ids, _ = self._encode(runs, self._pieces)
            ends = np.flatnonzero(self._closing[ids])  # of the words
            if len(ends) == len(cut):
                self._index.update(zip(cut, self._add(ids, np.diff(ends, prepend=-1))))
                known = set(cut)
                new = [w for w in new if w not in known]
        if self._keeps_spaces:  # white space may be inside a word, but not meet the space before the next one
            plain = [w for w in new if w and not (w[0].isspace() or w[-1].isspace())]
        else:  # printable words hold no white space
            plain = [w for w in new if w.isprintable() and w and "|" not in w]
        before = " " if self._keeps_spaces else ""
        self._index.update(zip(map(before.__add__, plain), self._learnt(plain)))
        known = set(plain)
        odd = [w for w in new if w not in known]
        self._index.update(zip(map(before.__add__, odd), self._add(*self._encode([" " + w for w in odd]))))

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after the other (uint32), and where each text's ids begin, with the end."""
        if len(self._index) > self._max:
            self._reset()
        heads, words, counts = [], [], np.zeros(len(texts), np.int64)
        for i, text in enumerate(texts):
            text = text or ""
            added = any(b in text for b in self._begins) and self._added.search(text)
            if (self._pieces or self._cuts_spaced) and not added and _PLAIN.fullmatch(text):
                cut = _PIECE.findall(text.lower()) if self._pieces else _SPACED_PIECE.findall(text)
                heads.append("")
                words += cut
                counts[i] = len(cut)
                continue
            if self._drops_newlines:
                text = text.replace("\n", " ")
            if added or _UNSAFE.search(text):
                heads.append(text)
            else:
                head = text.partition(" ")[0]
                tail = _WORD.findall(text, len(head)) if self._keeps_spaces else text.split(" ")[1:]
                heads.append(head)
                words += tail
                counts[i] = len(tail)
        known = self._index
        codes = np.fromiter(map(known.get, words, repeat(-1)), np.int64, len(words))
        missing = np.flatnonzero(codes < 0).tolist()
        if missing:
            new = list(dict.fromkeys(words[i] for i in missing))
            if self._keeps_spaces:
                first = [w for w in new if w[0] != " "]  # of a line, or symbols behind a word
                self._index.update(zip(first, self._add(*self._encode(first))))
                new = [w[1:] for w in new if w[0] == " "]
            self._learn(new)
            codes[missing] = [known[words[i]] for i in missing]
        mark = len(self._starts), len(self._ids)
        first = self._add(*self._encode(heads))
        # Each text is its head, its words and the end id, which has number 0.
        ends = np.cumsum(counts + 2)
        pieces = np.zeros(int(ends[-1]) if len(ends) else 0, np.int64)
        pieces[ends - counts - 2] = np.array(first, np.int64)
        pieces[np.arange(len(words)) + np.repeat(2 * np.arange(len(texts)) + 1, counts)] = codes
        lengths = np.frombuffer(self._lengths, np.int64)[pieces]
        starts = np.frombuffer(self._starts, np.int64)[pieces]
        done = np.concatenate(([0], np.cumsum(lengths)))
        at = np.repeat(starts - done[:-1], lengths) + np.arange(done[-1])
        ids = np.frombuffer(self._ids, np.uint32)[at]
        del self._starts[mark[0] :], self._lengths[mark[0] :], self._ids[mark[1] :]
        return ids, done[np.concatenate(([0], ends))]


_encoders: dict[tuple, WordEncoder] = {}


def encoder(path: str, end_id: int) -> WordEncoder:
    """This worker's encoder, kept from task to task with what it has learnt."""
    if (path, end_id) not in _encoders:
        _encoders[path, end_id] = WordEncoder(path, end_id)
    return _encoders[path, end_id]
