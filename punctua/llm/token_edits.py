"""Token counts that survive edits: a segment tree of pre-tokens per document, re-encoded only around each edit."""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from punctua.llm.batches import pieces

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Fixed value: the pre-token pattern that the vocabulary was made with.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
LEAF = 64  # pre-tokens in a leaf of a new tree
AHEAD = 64  # characters after an edit that are looked at first
CACHE = 200_000  # pre-tokens whose counts a worker remembers
EDIT = "array<struct<start:bigint,end:bigint,text:string>>"
REDACTIONS = (
    (r"[\w.+-]+@[\w-]+(?:\.[\w-]+)+", "[email]"),
    (r"\b\d{1,3}(?:\.\d{1,3}){3}\b", "[ip]"),
    (r"\+?\d[\d() -]{7,}\d", "[number]"),
)


class Counter:
    """Tokens of single pre-tokens, with a bounded memory of recent ones."""

    def __init__(self, vocabulary: str, pattern: str = PATTERN):
        with open(vocabulary, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.encoding = tiktoken.Encoding("counting", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.split = regex.compile(pattern).findall
        self.known: dict[str, int] = {}

    def count(self, pretokens: list[str]) -> list[int]:
        known = self.known
        for piece in set(pretokens).difference(known):
            known[piece] = len(self.encoding.encode_ordinary(piece))
        counts = [known[p] for p in pretokens]
        if len(known) > CACHE:
            known.clear()
        return counts


@lru_cache(maxsize=2)
def counter(vocabulary: str, pattern: str = PATTERN) -> Counter:
    """One counter per worker."""
    return Counter(vocabulary, pattern)


class TokenTree:
    """Pre-tokens of one text in leaves; every node knows the characters and tokens below it.

    A pre-token depends on the text from its start to one character past its end, and on nothing before. So an edit keeps all
    pre-tokens that end two or more characters before it, and all from the first place behind it where an old and a new pre-token start together.
    """

    def __init__(self, text: str, counter: Counter):
        self.counter, self.reencoded = counter, 0
        pretokens = counter.split(text)
        counts = counter.count(pretokens)
        self.leaves = [(pretokens[i:i + LEAF], counts[i:i + LEAF]) for i in range(0, len(pretokens), LEAF)] or [([], [])]
        self.width = 1 << (len(self.leaves) - 1).bit_length()
        self.chars, self.tokens = [0] * (2 * self.width), [0] * (2 * self.width)
        for i, (parts, numbers) in enumerate(self.leaves):
            self.chars[self.width + i], self.tokens[self.width + i] = sum(map(len, parts)), sum(numbers)
        for node in range(self.width - 1, 0, -1):
            self._sum(node)

    def _sum(self, node: int) -> None:
        self.chars[node] = self.chars[2 * node] + self.chars[2 * node + 1]
        self.tokens[node] = self.tokens[2 * node] + self.tokens[2 * node + 1]

    def _renew(self, leaf: int) -> None:
        parts, numbers = self.leaves[leaf]
        node = self.width + leaf
        self.chars[node], self.tokens[node] = sum(map(len, parts)), sum(numbers)
        while node > 1:
            node //= 2
            self._sum(node)

    @property
    def total(self) -> int:
        return self.tokens[1]

    def text(self) -> str:
        return "".join(p for parts, _ in self.leaves for p in parts)

    def _locate(self, at: int) -> tuple[int, int, int]:
        """Leaf, place in it and first character of the first pre-token that ends at ``at`` or later."""
        node, start = 1, 0
        while node < self.width:
            node *= 2
            if start + self.chars[node] < at:
                start += self.chars[node]
                node += 1
        leaf = min(node - self.width, len(self.leaves) - 1)
        for place, part in enumerate(self.leaves[leaf][0]):
            if start + len(part) >= at:
                return leaf, place, start
            start += len(part)
        return leaf, len(self.leaves[leaf][0]), start

    def edit(self, start: int, end: int, text: str) -> None:
        """Replace the characters from ``start`` to ``end`` by ``text``."""
        leaf, place, first = self._locate(max(start - 1, 0))
        old, ends, at, reach, last = [], [], first, (leaf, place), None  # old pre-tokens from here on, and where each ends
        ahead = AHEAD
        steps = self._from(leaf, place)
        while True:
            for spot, part in steps:
                old.append((spot, part))
                at += len(part)
                ends.append(at)
                if at >= end + ahead:
                    break
            else:
                last = len(old)  # all of the rest is here
            near = "".join(p for _, p in old)
            fresh = self.counter.split(near[:start - first] + text + near[end - first:])
            shift = len(text) - (end - start)
            bounds = {e: i + 1 for i, e in enumerate(ends) if e >= end}
            bounds |= {first: 0} if first >= end else {}
            new_at, keep = first, None
            for i in range(len(fresh) + 1):
                if new_at >= start + len(text) and new_at - shift in bounds:
                    keep = i, bounds[new_at - shift]
                    break
                if i < len(fresh):
                    new_at += len(fresh[i])
                    if last is None and new_at - shift > at - 2:
                        break  # what follows the window could change this one
            if keep is None and last is not None:
                keep = len(fresh), last
            if keep is not None:
                break
            ahead *= 2
        fresh, gone = fresh[:keep[0]], [spot for spot, _ in old[:keep[1]]]
        self.reencoded += len(fresh)
        parts, numbers = self.leaves[leaf]
        inside = sum(1 for spot in gone if spot[0] == leaf)
        parts[place:place + inside] = fresh
        numbers[place:place + inside] = self.counter.count(fresh)
        self._renew(leaf)
        for other in sorted({spot[0] for spot in gone} - {leaf}):
            n = sum(1 for spot in gone if spot[0] == other)
            del self.leaves[other][0][:n], self.leaves[other][1][:n]
            self._renew(other)

    def _from(self, leaf: int, place: int) -> Iterator[tuple[tuple[int, int], str]]:
        for i in range(leaf, len(self.leaves)):
            for j in range(place if i == leaf else 0, len(self.leaves[i][0])):
                yield (i, j), self.leaves[i][0][j]


def redactions(docs: DataFrame, rules: tuple[tuple[str, str], ...] = REDACTIONS) -> DataFrame:
    """``doc_id, text, edits``: replacements of personal data found in each whole text, in order and without overlap (the first rule wins)."""
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("text", pa.string())]))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = regex.compile("|".join(f"({p})" for p, _ in rules))
        for part in pieces(batches):
            edits = [[{"start": m.start(), "end": m.end(), "text": rules[m.lastindex - 1][1]} for m in search.finditer(t or "")] for t in part["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays([part["doc_id"], part["text"], pa.array(edits, kind)], names=["doc_id", "text", "edits"])

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(find, f"doc_id bigint, text string, edits {EDIT}")


def count_tokens(docs: DataFrame, vocabulary: str = VOCABULARY, pattern: str = PATTERN) -> DataFrame:
    """``doc_id, n_tokens, n_edits, n_tokens_after, n_pretokens, n_reencoded`` of every whole text.

    ``docs`` has ``doc_id, text, edits`` with ``edits`` as ``(start, end, text)`` in characters of the text as given, in any order, without
    overlap; of edits that overlap the one further left is applied, and places past the end are the end. The tree of a text is built once; each edit re-encodes its
    surroundings only (``n_reencoded`` pre-tokens in all), and the count after equals that of the edited text encoded anew.

    Null texts are empty, null edits none; each row is counted on its own, so repeated rows agree and null ids stay. ``vocabulary`` is a file
    that every executor can open.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = counter(vocabulary, pattern)
        for part in pieces(batches):
            out = []
            for text, edits in zip(part["text"].to_pylist(), part["edits"].to_pylist()):
                text = text or ""
                tree = TokenTree(text, tokens)
                before, n = tree.total, sum(len(p) for p, _ in tree.leaves)
                todo, reach = [], 0
                for e in sorted(edits or [], key=lambda e: (e["start"], e["end"])):
                    start, end = min(e["start"], len(text)), min(e["end"], len(text))
                    if start >= reach and end >= start:
                        todo.append((start, end, e["text"] or ""))
                        reach = end
                for edit in reversed(todo):
                    tree.edit(*edit)
                out.append((before, len(todo), tree.total, n, tree.reencoded))
            yield pa.RecordBatch.from_arrays([part["doc_id"], *[pa.array([r[i] for r in out], pa.int64()) for i in range(5)]],
                                             names=["doc_id", "n_tokens", "n_edits", "n_tokens_after", "n_pretokens", "n_reencoded"])

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", "edits").mapInArrow(
        run, "doc_id bigint, n_tokens bigint, n_edits bigint, n_tokens_after bigint, n_pretokens bigint, n_reencoded bigint")
