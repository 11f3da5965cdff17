"""Token ids of whole texts, exactly as the ``tokenizers`` library gives them.

The library merges once per distinct *unit*: a stretch of text that its
pre-tokenizer never joins to what stands beside it. Units are looked up in a
table that lives as long as the Python worker and is bounded (``MAX_UNITS``). It has
two halves: when the young one is full it becomes the old one, and what is met there
again moves over. So units met often stay, and only those not met for long go. For ``ids``, Arrow cuts a slice into
units and numbers the distinct ones; those that are words are merged by ``tiktoken`` where that is proven to give the
same, all in one call, and only the others go through the table. numpy lays the ids out.

Byte-level BPE: a text is cut before each space and around each newline, which is
safe where all white space (to Python or the library) is single spaces and newlines
between other characters; any other text goes to the library whole. Word BPE: white space only separates,
so the words are the units. Where all commas and stops follow a letter or digit
and stand beside no other punctuation, texts are cut before them as well.
"""

from __future__ import annotations

import json
import os
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from docsift.llm.worker import kept

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")   # Spark's tasks are the parallelism

MAX_UNITS = 400_000
MAX_WORDS = 800_000                                        # the same for the word vocabulary
JOINED = 4000                                              # units in one call's strings
_BESIDE = re.compile(r"[.,](?:(?<=[\W_].)|(?=[^\w\s]|_))")   # a comma or stop that is part of something longer
_NOT_SPACE = ("\x1c", "\x1d", "\x1e", "\x1f")              # white space to Python, text to the library
_OTHER_SPACE = tuple(c for c in map(chr, range(0x3001)) if c.isspace() and c not in " \n")
_LETTERS = re.compile(r"[a-z\xdf-\xf6\xf8-\xff]+")         # one pre-token whatever stands beside it


def load(path: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def _byte_of_sign() -> dict[str, int]:
    """The signs by which byte-level vocabularies write bytes: printable ones stand for themselves, others follow 255."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


def bytes_of_tokens(tokenizer) -> list[bytes]:
    """The bytes that each id of a byte-level vocabulary stands for."""
    sign = _byte_of_sign()
    return [bytes(map(sign.__getitem__, tokenizer.id_to_token(i))) for i in range(tokenizer.get_vocab_size())]


#: one pre-token of a byte-level vocabulary, whatever stands beside it
WORD = re.compile(r" ?[A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\xff]+")


def by_ranks(path: str, tokenizer):
    """The vocabulary of a byte-level BPE file for ``tiktoken``, which merges a word some times faster; None where it may differ.

    ``tokenizers`` merges the pair of the earliest rule, ``tiktoken`` any pair that makes the lowest id. Both merge alike
    where ids rise with the rules, the parts of each rule are older than what it makes (so merges happen in the order
    of ids), and every token is what its own bytes are merged to: then, of all ways to cut a token's bytes in two, only its
    rule's can be there when its turn comes. This is checked here, for all tokens.
    """
    import tiktoken

    token_bytes = bytes_of_tokens(tokenizer)
    with open(path, encoding="utf-8") as f:
        file = json.load(f)
    model, special = file["model"], {t["id"] for t in file["added_tokens"]}
    vocab = {t: i for t, i in model["vocab"].items() if i not in special}
    rules = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
    made = [vocab.get(x + y, -1) for x, y in rules]
    if (file["normalizer"] or file["pre_tokenizer"]["type"] != "ByteLevel" or model["type"] != "BPE"
            or any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix",
                                          "byte_fallback", "ignore_merges"))
            or any(i >= j for i, j in zip(made, made[1:])) or len(vocab) != 256 + len(rules)
            or any(max(vocab[x], vocab[y]) >= i for (x, y), i in zip(rules, made))
            or any([t.id for t in tokenizer.model.tokenize(sign)] != [i] for sign, i in vocab.items())):
        return None
    return tiktoken.Encoding("by-ranks", pat_str=r"\n|[^\n]+", mergeable_ranks={token_bytes[i]: i for i in vocab.values()},
                             special_tokens={})


_BREAK = 0xFFFFFFFF                                         # follows each word in what ``word_ranks`` gives


def _letter_codes() -> tuple[np.ndarray, np.ndarray]:
    """Codes below 128 for the UTF-8 bytes of lower-cased ``WORD`` letters, within a word and at its end; capitals have their small letter's."""
    small = [*range(0x61, 0x7B), 0xC3, *(b for b in range(0x9F, 0xC0) if b != 0xB7)]
    codes = iter(c for c in range(128) if c != 10)
    within, at_end = np.full(256, 10, np.uint8), np.full(256, 10, np.uint8)
    within[small] = [next(codes) for _ in small]
    ends = [b for b in small if b != 0xC3]
    at_end[ends] = [next(codes) for _ in ends]
    for table in within, at_end:
        table[0x41:0x5B] = table[0x61:0x7B]
        table[[*range(0x80, 0x97), *range(0x98, 0x9F)]] = table[[*range(0xA0, 0xB7), *range(0xB8, 0xBF)]]
    return within, at_end


def _lower_case_words(file: dict) -> bool:
    """Whether the file lower-cases texts and takes each run of letters as a pre-token, written as bytes; no added token is a word."""
    steps = [s.get("type") for s in (file["normalizer"] or {}).get("normalizers", [])]
    cut = (file["pre_tokenizer"] or {}).get("pretokenizers", [])
    return (steps == ["NFC", "Replace", "Lowercase"] and [s.get("type") for s in cut] == ["Split", "ByteLevel"]
            and file["normalizer"]["normalizers"][1]["pattern"] == {"Regex": r"\s+"}
            and r"|[\p{L}]+|" in cut[0]["pattern"].get("Regex", "") and not cut[1]["add_prefix_space"] and not cut[1]["use_regex"]
            and not any(WORD.fullmatch(t["content"]) for t in file["added_tokens"]))


def word_ranks(path: str, tokenizer):
    """A function that gives the ids of words of ``WORD``'s letters, each with a newline after it, by ``tiktoken``, as an array
    with ``_BREAK`` for each newline; None where they may differ from the library's.

    The vocabulary marks what ends a word with ``</w>``. Here a letter has one code within a word and another at its end;
    the ranks are the numbers of the rules that join such letters, and the conditions are those of ``by_ranks``.
    """
    import tiktoken
    from tokenizers.models import BPE

    with open(path, encoding="utf-8") as f:
        file = json.load(f)
    model, (within, at_end), byte = file["model"], _letter_codes(), _byte_of_sign()
    if (not _lower_case_words(file) or model["type"] != "BPE" or model.get("end_of_word_suffix") != "</w>"
            or any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "byte_fallback", "ignore_merges"))):
        return None

    def coded(token: str) -> str | None:
        ends, signs = token.endswith("</w>"), token.removesuffix("</w>")
        raw = [byte.get(c, 0) for c in signs]
        codes = [*within[raw[:-1]], (at_end if ends else within)[raw[-1]]] if raw else [10]
        capital = any(0x41 <= b <= 0x5A or 0x80 <= b <= 0x9E for b in raw)
        return None if capital or 10 in codes else "".join(map(chr, codes))

    special = {t["id"] for t in file["added_tokens"]}
    ids = {c: i for t, i in model["vocab"].items() if i not in special and (c := coded(t))}
    rules = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
    rules = [(x, y) for x, y in ((coded(x), coded(y)) for x, y in rules if not x.endswith("</w>")) if x and y]
    letters = [c for c in map(chr, range(128)) if c in ids]
    order = letters + [x + y for x, y in rules]
    rank = {t: k for k, t in enumerate(order)}
    codes = {c for table in (within, at_end) for c in table.tolist() if c != 10}
    if (set(map(ord, letters)) != codes or len(rank) != len(order) or rank.keys() != ids.keys()
            or any(max(rank[x], rank[y]) >= rank[x + y] for x, y in rules)):
        return None
    merged = BPE(vocab=rank, merges=rules)
    if any([t.id for t in merged.tokenize(token)] != [k] for token, k in rank.items()):
        return None
    encoding = tiktoken.Encoding("word-ranks", pat_str=r"\n|[^\n]+", special_tokens={},
                                 mergeable_ranks={t.encode(): k for t, k in rank.items()} | {b"\n": len(order)})
    id_of = np.array([ids[t] for t in order] + [_BREAK], dtype="<u4")

    def joined(words: bytes) -> np.ndarray:
        raw = np.frombuffer(words, np.uint8)
        last = np.flatnonzero(raw == 10) - 1
        codes = within[raw]
        codes[last] = at_end[raw[last]]
        return id_of[encoding.encode_ordinary(codes.tobytes().decode())]

    return joined


def packed(ids) -> bytes:
    return np.asarray(ids, dtype="<u4").tobytes()


class _Encoder:
    """unit -> value of its ids. ``value`` is ``packed`` (bytes, four to an id) or ``len``."""

    def __init__(self, path: str, value, known: dict):
        self.tokenizer, self.value, self.known = load(path), value, known
        self.units, self.old = dict(known), {}

    def most(self) -> int:
        return MAX_UNITS

    def one(self, text: str):
        return self.value(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def learn(self, units: set[str]) -> None:
        """Afterwards all ``units`` are in the young half."""
        new = units.difference(self.units)
        if len(self.units) + len(new) > len(self.known) + self.most() // 2:
            self.old, self.units = self.units, dict(self.known)
            new = units.difference(self.units)
        again = new.intersection(self.old)
        self.units.update((u, self.old[u]) for u in again)
        if new := new.difference(again):
            self.units.update(self.merged(list(new)))

    def joined_ids(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def by_ends(self, units: list[str], joint: str, is_end, joined_ids=None, lead: str = ""):
        """(units, ids, ends) of units that the library encodes alike alone and joined; ``is_end``: id -> whether it ends one.

        ``lead``: an end to put before the first unit, so that each stands between two.
        """
        blocks = [units[i:i + JOINED] for i in range(0, len(units), JOINED)]
        encoded = (joined_ids or self.joined_ids)([lead + joint.join(b) + joint for b in blocks])
        for block, ids in zip(blocks, encoded):
            ids = np.asarray(ids, dtype="<u4")
            if lead:
                first, ids = is_end(ids[:1]).all(), ids[1:]
            ends = np.flatnonzero(is_end(ids))
            if len(ends) != len(block) or (lead and not first):
                raise RuntimeError(f"{len(block)} units were encoded as {len(ends)}")
            yield block, ids, ends

    def marked(self, text: str) -> str | None:
        """The text with ``mark`` between its units; None where it has to go to the library whole."""
        raise NotImplementedError

    def split(self, text: str):
        raise NotImplementedError

    def ids(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one after another, and where each text ends in them. For ``packed`` values."""
        marked = [self.marked(t) if t else "" for t in texts]
        cut = pc.split_pattern(pa.array([m or "" for m in marked], pa.large_string()), self.mark)
        units = cut.values.dictionary_encode()
        flat, first, n = self.distinct_ids(units.dictionary)
        numbers = units.indices.to_numpy()
        first, n = first[numbers], n[numbers]
        ends = np.concatenate([[0], np.cumsum(n)])
        ids = flat[np.arange(ends[-1]) + np.repeat(first - ends[:-1], n)]
        ends = ends[cut.offsets.to_numpy()[1:]]
        if None in marked:
            parts = np.split(ids, ends[:-1])
            parts = [np.frombuffer(self.one(t), "<u4") if m is None else p for t, m, p in zip(texts, marked, parts)]
            ids, ends = np.concatenate(parts), np.cumsum([len(p) for p in parts])
        return ids, ends

    def distinct_ids(self, units: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of distinct ``units``, and where in them those of each unit begin and how many they are."""
        is_word = pc.match_substring_regex(units, self.words).to_numpy(zero_copy_only=False) & (self.ranks is not None)
        first, n = np.zeros(len(units), np.int64), np.zeros(len(units), np.int64)
        flat = np.zeros(0, "<u4")
        if is_word.any():
            words = units.filter(pa.array(is_word)).to_numpy(zero_copy_only=False)
            flat = self.word_ids("\n".join(words) + "\n")
            ends = np.flatnonzero(flat == self.after_word)
            if len(ends) != len(words):
                raise RuntimeError(f"{len(words)} words were encoded as {len(ends)}")
            n[is_word] = np.diff(ends, prepend=-1) - 1
            first[is_word] = ends - n[is_word]
        other = units.filter(pa.array(~is_word)).to_numpy(zero_copy_only=False).tolist()
        self.learn(set(other))
        values = list(map(self.units.__getitem__, other))
        n[~is_word] = sizes = np.fromiter(map(len, values), np.int64, len(values)) // 4
        first[~is_word] = len(flat) + np.cumsum(sizes) - sizes
        return np.concatenate([flat, np.frombuffer(b"".join(values), "<u4")]), first, n

    def ids_and_end(self, texts: list[str], end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """``ids``, with ``end_id`` after those of each text."""
        ids, ends = self.ids(texts)
        return np.insert(ids, ends, end_id), ends + np.arange(1, len(ends) + 1)

    def values(self, texts: list[str]) -> list[list]:
        """For each text, the values of its units in order."""
        split = [self.split(t) if t else () for t in texts]
        self.learn({u for units in split if units for u in units})
        get = self.units.__getitem__
        return [[self.one(t)] if units is None else list(map(get, units)) for t, units in zip(texts, split)]


def byte_level_marked(text: str) -> str | None:
    """A text with a zero byte between its units for a byte-level tokenizer; None where it has to go to the library whole."""
    if not text or "\x00" in text or any(c in text for c in _OTHER_SPACE):
        return None
    if text[0] in " \n" or text[-1] in " \n" or any(c in text for c in ("  ", " \n", "\n ", "\n\n")):
        return None
    if not _BESIDE.search(text):
        text = text.replace(",", "\x00,").replace(".", "\x00.")
    return text.replace(" ", "\x00 ").replace("\n", "\x00\n\x00")


def byte_level_units(text: str) -> list[str] | None:
    """Units of a text for a byte-level tokenizer; None where it has to go to the library whole."""
    marked = byte_level_marked(text)
    return None if marked is None else marked.split("\x00")


class ByteLevel(_Encoder):
    mark, words = "\x00", r"\A%s\z" % WORD.pattern

    def __init__(self, path: str, value=packed, known: dict | None = None):
        super().__init__(path, value, {})
        self.newline = self.tokenizer.encode("\n", add_special_tokens=False).ids[0]
        self.ranks, self.after_word = by_ranks(path, self.tokenizer), self.newline
        self.known = {**(known or {}), "": value([]), "\n": value([self.newline])}
        self.units = dict(self.known)

    def marked(self, text: str) -> str | None:
        return byte_level_marked(text)

    def split(self, text: str):
        return byte_level_units(text)

    def word_ids(self, joined: str) -> np.ndarray:
        return np.array(self.ranks.encode_ordinary(joined), dtype="<u4")

    def merged(self, units: list[str]):
        words = [u for u in units if WORD.fullmatch(u)] if self.ranks else []
        other = set(units).difference(words)
        yield from self._merged(words, lambda texts: list(map(self.ranks.encode_ordinary, texts)))
        yield from self._merged(list(other), None)

    def _merged(self, units: list[str], joined_ids):
        for block, ids, ends in self.by_ends(units, "\n", lambda ids: ids == self.newline, joined_ids, lead="\n"):
            start = 0
            raw = ids.tobytes()
            if self.value is len:
                yield from zip(block, (np.diff(ends, prepend=-1) - 1).tolist())
                continue
            for unit, end in zip(block, ends.tolist()):
                yield unit, raw[4 * start:4 * end]
                start = end + 1


class WordLevel(_Encoder):
    mark, words, after_word = " ", r"\A%s\z" % WORD.pattern.removeprefix(" ?"), _BREAK

    def __init__(self, path: str, value=packed):
        super().__init__(path, value, {"": value([])})
        self.ranks = word_ranks(path, self.tokenizer)
        vocab = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocab.values()) + 1, dtype=bool)
        self.ends[[i for token, i in vocab.items() if token.endswith("</w>")]] = True

    def most(self) -> int:
        return MAX_WORDS

    def marked(self, text: str) -> str | None:
        if any(c in text for c in _NOT_SPACE):
            return None
        if not _BESIDE.search(text):
            text = text.replace(",", " ,").replace(".", " .")
        return " ".join(text.split()) if any(c in text for c in _OTHER_SPACE) else text.replace("\n", " ")

    def split(self, text: str):
        marked = self.marked(text)
        return None if marked is None else marked.split()

    def word_ids(self, joined: str) -> np.ndarray:
        return self.ranks(joined.encode())

    def merged(self, units: list[str]):
        lower = [u for u in units if _LETTERS.fullmatch(u)]
        for block, ids, ends in self.by_ends(lower, " ", self.ends.__getitem__):
            start = 0
            raw = ids.tobytes()
            for unit, end in zip(block, ends.tolist()):
                yield unit, raw[4 * start:4 * end + 4]
                start = end + 1
        other = [u for u in units if not _LETTERS.fullmatch(u)]
        encoded = self.tokenizer.encode_batch_fast(other, add_special_tokens=False)
        yield from ((u, self.value(e.ids)) for u, e in zip(other, encoded))


def byte_level(path: str) -> ByteLevel:
    """One per Python worker."""
    return kept((ByteLevel, path), lambda: ByteLevel(path))


def word_level(path: str) -> WordLevel:
    return kept((WordLevel, path), lambda: WordLevel(path))


def slices(texts: list[str], chars: int = 1_000_000):
    """Slices of ``texts`` of about ``chars`` characters (one text at least)."""
    start = n = 0
    for i, text in enumerate(texts):
        n += len(text)
        if n >= chars:
            yield slice(start, i + 1)
            start, n = i + 1, 0
    if start < len(texts):
        yield slice(start, len(texts))


def whole_tokens(path: str) -> list[str]:
    """The vocabulary strings that encode alone as exactly their one token. Bounded by the vocabulary."""
    tokenizer = load(path)
    texts = [(tokenizer.decode([i], skip_special_tokens=False), i) for i in range(tokenizer.get_vocab_size())]
    encoded = tokenizer.encode_batch_fast([t for t, _ in texts], add_special_tokens=False)
    return [t for (t, i), e in zip(texts, encoded) if t and e.ids == [i]]
