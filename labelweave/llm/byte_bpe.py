"""Byte-level BPE seen piece by piece.

The pre-tokenizer cuts a text into pieces and no token crosses a cut, so the
token counts of a piece's prefixes hold wherever the piece occurs. Natural text repeats its pieces; a bounded cache makes a text
cost one regular-expression pass and a lookup per piece.
"""

import array
import json
import re
from functools import lru_cache

import numpy as np
import public_tokenizers
import regex
import tiktoken
from tokenizers import Tokenizer

DEFAULT_FILE = "byte_bpe_50k.json"
CACHE_PIECES = 150_000
CACHE_KEY_CHARS = 64
HEAD_BYTES = 6
# On these characters all regular-expression engines agree; any other text is
# left to the tokenizer library itself.
_UNUSUAL = re.compile("[^\u0000-ԯ‐-⁠]")
_BLANK_RUN = regex.compile(r"\s\s")


def byte_characters():
    """The printable stand-in of every byte in the vocabulary file: printable
    Latin-1 stands for itself, the others follow from 256 on in order."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    stand_in, spare = {}, 256
    for byte in range(256):
        if byte in printable:
            stand_in[byte] = chr(byte)
        else:
            stand_in[byte], spare = chr(spare), spare + 1
    return stand_in


class TwoAges(dict):
    """A bounded cache: what was used since the last turn outlives the next one.

    Plain lookups see the young half only, at the speed of a dictionary; ``get``
    brings an entry of the old half back. Long keys are not kept.
    """

    def __init__(self, size):
        super().__init__()
        self.size, self.old = size, {}

    def get(self, key):
        found = dict.get(self, key)
        if found is None:
            found = self.old.get(key)
            if found is not None:
                self.put(key, found)
        return found

    def put(self, key, value):
        if isinstance(key, str) and len(key) > CACHE_KEY_CHARS:
            return
        if len(self) >= self.size:
            self.old = dict(self)
            self.clear()
        self[key] = value


class PieceBpe:
    def __init__(self, path):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        cutter = spec["pre_tokenizer"]
        if cutter["type"] != "ByteLevel" or cutter["add_prefix_space"] or spec["normalizer"]:
            raise ValueError(f"{path} is not a plain byte-level tokenizer")
        for added in spec["added_tokens"]:
            if added["lstrip"] or added["rstrip"] or added["single_word"]:
                raise ValueError(f"{path} has added tokens that reach beyond themselves")
        self.library = Tokenizer.from_file(path)
        self.added = {a["content"]: a["id"] for a in spec["added_tokens"]}
        self._added_cut = re.compile("(" + "|".join(map(re.escape, self.added)) + ")") if self.added else None
        self._cut = regex.compile(public_tokenizers.PATTERN)
        self._letter = byte_characters()
        back = {c: b for b, c in self._letter.items()}
        as_bytes = lambda word: bytes(back[c] for c in word)
        # Rank of every token: the bytes first, then the merges in their order.
        self._rank = {bytes([b]): b for b in range(256)}
        self._halves = {b: (b, b) for b in range(256)}
        self._merged = {}
        for merge in spec["model"]["merges"]:
            left, right = map(as_bytes, merge if isinstance(merge, list) else merge.split(" "))
            halves = self._rank[left], self._rank[right]
            rank = self._rank.setdefault(left + right, len(self._rank))
            self._halves.setdefault(rank, halves)
            self._merged[halves] = rank
        self._longest = max(map(len, self._rank))
        # The same vocabulary for an encoder that is several times faster.
        ids = {as_bytes(t): i for t, i in spec["model"]["vocab"].items() if t not in self.added}
        self._make_fast = lambda: tiktoken.Encoding(
            path, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ids, special_tokens=self.added)
        self._fast = None
        self._steps = TwoAges(CACHE_PIECES)
        self._follows, self._heads = TwoAges(CACHE_PIECES), TwoAges(CACHE_PIECES)

    def _plain_pieces(self, text):
        if text.isascii() or not _UNUSUAL.search(text):
            return self._cut.findall(text)
        return [text[a:b] for _, (a, b) in self.library.pre_tokenizer.pre_tokenize_str(text)]

    def pieces(self, text):
        """Pieces and added tokens of a text, in order; joined they are the text."""
        if self._added_cut is None or not self._added_cut.search(text):
            return self._plain_pieces(text)
        out = []
        for part in self._added_cut.split(text):
            if part in self.added:
                out.append(part)
            elif part:
                out += self._plain_pieces(part)
        return out

    def text_ids(self, text):
        """Ids of a text as an array of unsigned 32-bit numbers."""
        if text.isascii() or not _UNUSUAL.search(text):
            self._fast = self._fast or self._make_fast()
            return self._fast.encode_to_numpy(text, allowed_special=set(self.added))
        return np.array(self.library.encode(text, add_special_tokens=False).ids, np.uint32)

    def _may_follow(self, left, right):
        """Whether BPE leaves these two tokens (as ranks) side by side.

        It does unless, while both are built, some pair that meets at the cut
        would merge before the merge that takes one of the two away from it.
        """
        before = len(self._rank)
        while True:
            if self._merged.get((left, right), before) < before:
                return False
            if left > right:  # the later merge is undone first
                if left < 256:
                    return True
                before, left = left, self._halves[left][1]
            else:
                if right < 256:
                    return True
                before, right = right + 1, self._halves[right][0]

    def _prefix_counts(self, data):
        """Token count of every byte prefix of one piece.

        The encoding of a prefix ends in the one token whose left neighbour is
        the last token of the shorter prefix and which may follow it.
        """
        head = data[:HEAD_BYTES]
        state = self._heads.get(head) if len(data) > HEAD_BYTES else None
        counts, last = (list(state[0]), list(state[1])) if state else ([0], [-1])
        rank, follows = self._rank, self._follows
        for end in range(len(counts), len(data) + 1):
            for start in range(max(0, end - self._longest), end):
                token = rank.get(data[start:end])
                if token is None:
                    continue
                if start:
                    key = last[start] << 20 | token
                    fits = follows.get(key)
                    if fits is None:
                        fits = self._may_follow(last[start], token)
                        follows.put(key, fits)
                    if not fits:
                        continue
                counts.append(counts[start] + 1)
                last.append(token)
                break
            else:
                raise ValueError("the vocabulary lacks a byte")
            if end == HEAD_BYTES and len(data) > HEAD_BYTES:
                self._heads.put(head, (tuple(counts), tuple(last)))
        return counts

    def piece_steps(self, piece):
        """By how much each further character changes the token count."""
        found = self._steps.get(piece)
        if found is not None:
            return found
        if piece in self.added:
            steps = bytes(len(piece) - 1) + b"\1"  # its inner prefixes depend on what stands before
        else:
            data = piece.encode()
            counts = self._prefix_counts(data)
            if len(data) != len(piece):
                counts = [c for i, c in enumerate(counts) if i == len(data) or data[i] & 0xC0 != 0x80]
            if piece[0] == "'" and len(piece) == 3 and piece.isascii() and piece[1:].isalpha():
                counts[2] = self.count("'") + self.count(piece[1])  # half a contraction is two pieces
            steps = array.array("b", [b - a for a, b in zip(counts, counts[1:])]).tobytes()
        self._steps.put(piece, steps)
        return steps

    def count(self, piece):
        return sum(array.array("b", self.piece_steps(piece)))

    def text_steps(self, text):
        """By how much each character of the text changes the token count of
        the text so far, one signed byte per character. Running sums are the
        token counts of all prefixes; the total is the count of the text."""
        parts = self.pieces(text)
        known = self._steps
        steps = b"".join([known[p] if p in known else self.piece_steps(p) for p in parts])
        if _BLANK_RUN.search(text) or (self._added_cut and self._added_cut.search(text)):
            steps = self._mend(array.array("b", steps), parts).tobytes()
        return steps

    def _mend(self, steps, parts):
        """Prefixes that end where the pieces depend on what follows: inside an
        added token, and after the last blank of a run."""
        at, before = 0, ""
        for part in parts:
            if part in self.added:
                kept = before if before not in self.added else ""
                reached = sum(map(self.count, [kept])) if kept else 0
                for i in range(1, len(part)):
                    now = sum(map(self.count, self._plain_pieces(kept + part[:i])))
                    steps[at + i - 1], reached = now - reached, now
                steps[at + len(part) - 1] = (self.count(kept) if kept else 0) + 1 - reached
            elif before.isspace() and part[0].isspace():
                run = self._plain_pieces(before + part[0])
                change = sum(map(self.count, run)) - self.count(before) - self.count(part[0])
                steps[at] += change
                if at + 1 < len(steps):
                    steps[at + 1] -= change
            at, before = at + len(part), part
        return steps


@lru_cache(maxsize=4)
def load(path=None):
    return PieceBpe(path or public_tokenizers.path(DEFAULT_FILE))
