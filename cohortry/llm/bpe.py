"""Byte-level BPE vocabularies and the two ways to apply them: heap merging and trie traversal."""

from __future__ import annotations

import heapq
import json
from collections import ChainMap
from functools import lru_cache

import numpy as np
import regex
from pyspark.sql import SparkSession

#: The split pattern of the byte-level pre-tokenizer.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Words, pairs and counts that a worker remembers; more make it start over.
REMEMBERED = 600_000
#: The same for the bytes of remembered words and their codes.
REMEMBERED_BYTES = 48 << 20
#: Words longer than this many characters are encoded on their own and not remembered.
LONG_WORD = 256


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in the vocabulary files: printable Latin-1 as itself, the rest from U+0100 on."""
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    letters, spare = {}, 256
    for byte in range(256):
        if byte in own:
            letters[chr(byte)] = byte
        else:
            letters[chr(spare)] = byte
            spare += 1
    return letters


class Vocabulary:
    """Tokens, merge ranks and special strings of a byte-level BPE file."""

    def __init__(self, raw: str):
        spec = json.loads(raw)
        model, pre = spec["model"], spec["pre_tokenizer"] or {}
        plain = model["type"] == "BPE" and pre.get("type") == "ByteLevel" and pre.get("use_regex", True)
        odd = [k for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges") if model.get(k)]
        if not plain or odd or spec.get("normalizer") or pre.get("add_prefix_space"):
            raise ValueError(f"only plain byte-level BPE files are supported, not {model['type']} with {odd or pre}")
        letters = byte_letters()
        to_bytes = lambda token: bytes(letters[c] for c in token)
        self.ids = {to_bytes(t): i for t, i in model["vocab"].items()}
        self.tokens = {i: t for t, i in self.ids.items()}
        self.longest = max(map(len, self.ids))
        self.byte_ids = [self.ids[bytes([b])] for b in range(256)]
        self.ranks: dict[int, int] = {}
        self.merged: list[int] = []
        for rank, pair in enumerate(model["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            a, b = to_bytes(left), to_bytes(right)
            self.ranks.setdefault(self.ids[a] << 24 | self.ids[b], rank)
            self.merged.append(self.ids[a + b])
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        for content, token_id in self.special.items():
            self.tokens[token_id] = content.encode()
        ordered = sorted(self.special, key=len, reverse=True)
        self.special_re = regex.compile("(" + "|".join(map(regex.escape, ordered)) + ")") if ordered else None
        self.split = regex.compile(SPLIT).findall

    def segments(self, text: str) -> list[str]:
        """The text cut at special strings, which are the items at odd places."""
        if self.special_re is None or "<" not in text and not any(s in text for s in self.special):
            return [text]
        return self.special_re.split(text)

    def merge(self, piece: bytes) -> list[int]:
        """Token ids of one pre-token: pop the lowest-ranked adjacent pair (leftmost first) from a heap and join it in a
        linked list of symbols, until no adjacent pair has a rank."""
        symbols = [self.byte_ids[b] for b in piece]
        n, ranks, merged = len(symbols), self.ranks, self.merged
        if n < 2:
            return symbols
        after, before = [*range(1, n), -1], [*range(-1, n - 1)]
        heap = [r << 32 | i for i in range(n - 1) if (r := ranks.get(symbols[i] << 24 | symbols[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            entry = heapq.heappop(heap)
            at, rank = entry & 0xFFFFFFFF, entry >> 32
            right = after[at]
            if symbols[at] < 0 or right < 0 or ranks.get(symbols[at] << 24 | symbols[right]) != rank:
                continue  # one of the two was merged meanwhile
            symbols[at], symbols[right] = merged[rank], -1
            beyond = after[at] = after[right]
            if beyond >= 0:
                before[beyond] = at
                if (r := ranks.get(symbols[at] << 24 | symbols[beyond])) is not None:
                    heapq.heappush(heap, r << 32 | at)
            if (left := before[at]) >= 0 and (r := ranks.get(symbols[left] << 24 | symbols[at])) is not None:
                heapq.heappush(heap, r << 32 | left)
        return [s for s in symbols if s >= 0]

    def merge_count(self, piece: bytes) -> int:
        """How many tokens a pre-token has: its symbols less the merges made; no list of ids is kept."""
        symbols = [self.byte_ids[b] for b in piece]
        count = n = len(symbols)
        if n < 2:
            return n
        ranks, merged = self.ranks, self.merged
        after, before = [*range(1, n), -1], [*range(-1, n - 1)]
        heap = [r << 32 | i for i in range(n - 1) if (r := ranks.get(symbols[i] << 24 | symbols[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            entry = heapq.heappop(heap)
            at, rank = entry & 0xFFFFFFFF, entry >> 32
            right = after[at]
            if symbols[at] < 0 or right < 0 or ranks.get(symbols[at] << 24 | symbols[right]) != rank:
                continue
            count -= 1
            symbols[at], symbols[right] = merged[rank], -1
            beyond = after[at] = after[right]
            if beyond >= 0:
                before[beyond] = at
                if (r := ranks.get(symbols[at] << 24 | symbols[beyond])) is not None:
                    heapq.heappush(heap, r << 32 | at)
            if (left := before[at]) >= 0 and (r := ranks.get(symbols[left] << 24 | symbols[at])) is not None:
                heapq.heappush(heap, r << 32 | left)
        return count


def shipped(spark: SparkSession, path: str):
    """The vocabulary file as a broadcast string; the driver alone reads the path. Files are a few MB."""
    with open(path, encoding="utf-8") as f:
        return spark.sparkContext.broadcast(f.read())


class WordCounts(dict):
    """Pre-token to its number of tokens, filled on demand, emptied when it has REMEMBERED entries."""

    def __init__(self, vocab: Vocabulary):
        super().__init__()
        self.vocab = vocab

    def __missing__(self, word: str) -> int:
        count = self.vocab.merge_count(word.encode())
        if len(word) <= LONG_WORD:
            if len(self) >= REMEMBERED:
                self.clear()
            self[word] = count
        return count

    def of_text(self, text: str) -> int:
        total = 0
        for place, segment in enumerate(self.vocab.segments(text)):
            total += 1 if place % 2 else sum(map(self.__getitem__, self.vocab.split(segment)))
        return total


class TrieCodec:
    """Encodings of distinct words by a depth-first walk over their trie.

    The encoding of a prefix ends in exactly one token: the suffix token that is compatible with the last token of the
    encoding of what stands before it. So a walk needs only the last token of each prefix on the path, and words that
    share a prefix share the work for it. Two tokens are compatible if BPE leaves their concatenation as these two.
    """

    def __init__(self, vocab: Vocabulary):
        self.vocab = vocab
        self.packed = {i: i.to_bytes(4, "little") for i in vocab.tokens}
        self.words: dict[str, bytes] = {}
        self.by_id = [vocab.tokens.get(i, b"") for i in range(max(vocab.tokens) + 1)]
        self.held = 0  # bytes of words and codes
        self.pairs: dict[int, bool] = {}

    def compatible(self, left: int, token: int) -> bool:
        """Whether ``token`` can follow ``left``; left -1: whether it stands alone."""
        key = left << 24 | token if left >= 0 else -1 - token
        known = self.pairs.get(key)
        if known is None:
            if len(self.pairs) >= REMEMBERED:
                self.pairs.clear()
            tokens = self.vocab.tokens
            want = [token] if left < 0 else [left, token]
            known = self.pairs[key] = self.vocab.merge(b"".join(tokens[t] for t in want)) == want
        return known

    def step(self, path: bytes, last: list[int]) -> tuple[int, int]:
        """The last token of the encoding of ``path`` and where it starts: the longest suffix that is a token and can follow
        the last token of what stands before it."""
        get, pairs, depth = self.vocab.ids.get, self.pairs, len(path)
        for start in range(max(0, depth - self.vocab.longest), depth):
            token = get(path[start:])
            if token is not None:
                left = last[start]
                fits = pairs.get(left << 24 | token if left >= 0 else -1 - token)
                if fits or fits is None and self.compatible(left, token):
                    return token, start
        raise ValueError("no compatible token: the vocabulary is not closed under its merges")

    def walk(self, words: list[str]) -> None:
        """Insert words into a trie, then propagate last-token states depth first and store each word's encoding."""
        root: dict = {}
        for word in words:
            node = root
            for byte in word.encode():
                node = node.setdefault(byte, {})
            node[-1] = word
        last, codes = [-1] * (LONG_WORD * 4 + 2), [b""] * (LONG_WORD * 4 + 2)
        stack = [(bytes((byte,)), child) for byte, child in root.items()]
        step, packed = self.step, self.packed
        while stack:
            path, node = stack.pop()
            depth = len(path)
            token, start = step(path, last)
            last[depth], codes[depth] = token, codes[start] + packed[token]
            for key, child in node.items():
                if key == -1:
                    self.words[child] = codes[depth]
                    self.held += 4 * len(child) + 2 * len(codes[depth])
                else:
                    stack.append((path + bytes((key,)), child))

    def single(self, word: str) -> bytes:
        """The same states along one path, for a long word."""
        path = word.encode()
        last, starts = [-1] * (len(path) + 1), [0] * (len(path) + 1)
        for depth in range(1, len(path) + 1):
            low = max(0, depth - self.vocab.longest)
            last[depth], start = self.step(path[low:depth], last[low:depth])
            starts[depth] = low + start
        found, at = [], len(path)
        while at:
            found.append(self.packed[last[at]])
            at = starts[at]
        return b"".join(reversed(found))

    def learn(self, texts: list[str]) -> tuple[list[list[str]], dict[str, bytes]]:
        """Split texts into words and make sure that all their encodings are known: those of long words in the second
        result, the others in ``words``. Special strings stand between words at their place, marked by a leading NUL pair."""
        if len(self.words) >= REMEMBERED or self.held >= REMEMBERED_BYTES:
            self.words.clear()
            self.held = 0
        split_texts, fresh = [], set()
        for text in texts:
            words: list[str] = []
            for place, segment in enumerate(self.vocab.segments(text)):
                if place % 2:
                    words.append(f"\0\0{segment}")
                    self.words[words[-1]] = self.packed[self.vocab.special[segment]]
                else:
                    pieces = self.vocab.split(segment)
                    words += pieces
                    fresh.update(pieces)
            split_texts.append(words)
        fresh -= self.words.keys()
        self.walk([w for w in fresh if len(w) <= LONG_WORD])
        return split_texts, {w: self.single(w) for w in fresh if len(w) > LONG_WORD}

    def encode(self, texts: list[str]) -> list[list[bytes]]:
        """For each text the packed ids of its words."""
        split_texts, long = self.learn(texts)
        known = self.words if not long else ChainMap(long, self.words)
        return [list(map(known.__getitem__, words)) for words in split_texts]

    def decode(self, packed: bytes) -> str:
        """The text of packed ids."""
        ids = np.frombuffer(packed, "<u4").tolist()
        return b"".join(map(self.by_id.__getitem__, ids)).decode("utf-8", "replace")


@lru_cache(maxsize=1)
def worker_counts(raw: str) -> WordCounts:
    """One cache for all tasks that a worker runs."""
    return WordCounts(Vocabulary(raw))


@lru_cache(maxsize=1)
def worker_codec(raw: str) -> TrieCodec:
    return TrieCodec(Vocabulary(raw))
