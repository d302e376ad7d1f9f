"""Byte-pair encoding and decoding with a pair occurrence index.

A batch of texts is cut at ASCII white space into chunks; each different chunk is normalised and cut
into words by the rules of the vocabulary file. The new words of a batch stand one behind the other in
one sequence of symbols, and an index maps each mergeable pair to all its positions there. The pairs'
ranks are applied in ascending order: all positions of the lowest active rank are merged from left to
right, and the lists of the pairs that come about on both sides are extended. A position whose pair is
gone is skipped when its list is reached. If a merge makes a pair of lower rank, that one is applied
first and the rest of the list waits, so each word gets the merges it would get alone.

Words and chunks met before are looked up, in tables of bounded size. Texts are encoded whole, however
long, and nothing is shuffled: the vocabulary (a few MB, whatever the corpus) is broadcast.

Null and empty texts have no tokens. Bytes that are not UTF-8 count as U+FFFD. The strings of special
tokens in a text become those tokens. Symbols that the vocabulary lacks are left out, as are ids without
a token in decoding. Repeated rows are encoded alike. Input columns named like an output column are
replaced. An empty table stays empty.
"""

from __future__ import annotations

import gc
import json
import re
import sys
from array import array
from collections.abc import Iterable, Iterator
from heapq import heappop, heappush
from itertools import accumulate

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from plantlens.llm.common import map_texts

KNOWN_ENTRIES = 400_000
KNOWN_BYTES = 64
IDS = array("I").typecode


def read_vocabulary(path: str) -> dict:
    """What the executors need of a vocabulary file, in plain lists and dicts.

    The file is read on the driver. Features that this module doesn't have are refused.
    """
    with open(path, encoding="utf-8") as file:
        whole = json.load(file)
    model = whole["model"]
    unknown = [
        name
        for name in ("dropout", "unk_token", "continuing_subword_prefix", "byte_fallback", "ignore_merges")
        if model.get(name)
    ]
    plain = all(not t["normalized"] and not (t["single_word"] or t["lstrip"] or t["rstrip"]) for t in whole["added_tokens"])
    if model["type"] != "BPE" or unknown or not plain or whole["decoder"] or whole["post_processor"]:
        raise ValueError(f"{path} asks for more than plain merges: {unknown or 'model, decoder or added tokens'}")
    ids = model["vocab"]
    suffix = model.get("end_of_word_suffix") or ""
    merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
    rules = {k: whole[k] for k in ("version", "normalizer", "pre_tokenizer")}
    rules["model"] = {"type": "BPE", "vocab": {}, "merges": []}
    return {
        "rules": json.dumps(rules),
        "suffix": suffix,
        "tokens": {**{i: t for t, i in ids.items()}, **{t["id"]: t["content"] for t in whole["added_tokens"]}},
        "symbols": {t: i for t, i in ids.items() if len(t.removesuffix(suffix)) == 1},
        "special": {t["content"]: t["id"] for t in whole["added_tokens"]},
        "merges": [(ids[a], ids[b], ids[a + b]) for a, b in merges],
    }


class PairIndex:
    """Merges of a vocabulary, applied to many words at once."""

    def __init__(self, merges: list[tuple[int, int, int]]):
        self.merges = merges
        size = 1 + max((max(merge) for merge in merges), default=0)
        nothing: dict[int, int] = {}
        self.ranks = [nothing] * size  # by left symbol, then by right symbol
        for rank, (left, right, _) in enumerate(merges):
            if self.ranks[left] is nothing:
                self.ranks[left] = {}
            self.ranks[left][right] = rank  # of a pair listed twice the last rank holds

    def apply(self, words: list[list[int]]) -> list[list[int]]:
        """The words after all merges that apply to them."""
        ranks, merges = self.ranks, self.merges
        symbols = [s for word in words for s in word]
        ends = list(accumulate(map(len, words)))
        after = list(range(1, len(symbols) + 1))
        before = list(range(-1, len(symbols) - 1))
        places: dict[int, list[int]] = {}
        at = 0
        for word, end in zip(words, ends, strict=True):
            if at < end:
                before[at] = after[end - 1] = -1
                for left, right in zip(word, word[1:], strict=False):
                    rank = ranks[left].get(right)
                    if rank is not None:
                        if rank in places:
                            places[rank].append(at)
                        else:
                            places[rank] = [at]
                    at += 1
                at = end
        active = sorted(places)
        while active:
            rank = heappop(active)
            left, right, merged = merges[rank]
            follow = ranks[merged]
            listed = sorted(places.pop(rank))
            for done, at in enumerate(listed, 1):
                gone = after[at]
                if symbols[at] != left or gone < 0 or symbols[gone] != right:
                    continue
                symbols[at], symbols[gone] = merged, -1
                behind, ahead = before[at], after[gone]
                after[at] = ahead
                lowest = rank
                if behind >= 0:
                    added = ranks[symbols[behind]].get(merged)
                    if added is not None:
                        if added in places:
                            places[added].append(behind)
                        else:
                            places[added] = [behind]
                            heappush(active, added)
                        lowest = min(lowest, added)
                if ahead >= 0:
                    before[ahead] = at
                    added = follow.get(symbols[ahead])
                    if added is not None:
                        if added in places:
                            places[added].append(at)
                        else:
                            places[added] = [at]
                            heappush(active, added)
                        lowest = min(lowest, added)
                if lowest < rank and done < len(listed):
                    places.setdefault(rank, []).extend(listed[done:])
                    heappush(active, rank)
                    break
        out, begin = [], 0
        for end in ends:
            out.append([s for s in symbols[begin:end] if s >= 0])
            begin = end
        return out


class Encoder:
    """Encodes batches of texts; remembers short chunks and words."""

    def __init__(self, vocabulary: dict):
        from tokenizers import Tokenizer

        rules = Tokenizer.from_str(vocabulary["rules"])
        self.normalise = rules.normalizer.normalize_str if rules.normalizer else str
        self.cut = rules.pre_tokenizer.pre_tokenize_str
        self.symbols, self.suffix = vocabulary["symbols"], vocabulary["suffix"]
        self.special = vocabulary["special"]
        ordered = sorted(self.special, key=len, reverse=True)
        self.at_special = re.compile(f"({'|'.join(map(re.escape, ordered))})") if ordered else None
        self.index = PairIndex(vocabulary["merges"])
        self.words: dict[str, bytes] = {}
        self.chunks: dict[bytes, bytes] = {}

    def parts(self, chunk: str) -> list[str | int]:
        """Words of a chunk in the vocabulary's alphabet, and ids of special tokens."""
        out: list[str | int] = []
        for piece in self.at_special.split(chunk) if self.at_special else [chunk]:
            if piece in self.special:
                out.append(self.special[piece])
            elif piece:
                out += [word for word, _ in self.cut(self.normalise(piece))]
        return out

    def parts_of_all(self, chunks: list[bytes]) -> Iterator[tuple[bytes, list[str | int]]]:
        """`parts` of each chunk; all that hold no white space or special token go in one call."""
        plain: list[tuple[bytes, str]] = []
        for chunk in chunks:
            text = chunk.decode("utf-8", "replace")
            if text.split() == [text] and not (self.at_special and self.at_special.search(text)):
                plain.append((chunk, text))
            else:
                yield chunk, self.parts(text)
        normal = self.normalise("\n".join([text for _, text in plain]))
        lengths = [len(text) for text in normal.split(" ")]
        if len(lengths) != len(plain):  # the rules see white space, or take it away, where Python does not
            yield from ((chunk, self.parts(text)) for chunk, text in plain)
            return
        words = iter(self.cut(normal))
        word, (begin, _) = next(words, ("", (len(normal) + 1, 0)))
        end = -1
        for (chunk, _), length in zip(plain, lengths, strict=True):
            end += length + 1
            found: list[str | int] = []
            while begin < end:
                found.append(word)
                word, (begin, _) = next(words, ("", (len(normal) + 1, 0)))
            yield chunk, found

    def start(self, word: str) -> list[int]:
        found = list(map(self.symbols.get, word[:-1]))
        found.append(self.symbols.get(word[-1] + self.suffix))
        return [s for s in found if s is not None] if None in found else found

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        cut = [text.split() for text in texts]
        fresh = dict(self.parts_of_all(list(set().union(*cut) - self.chunks.keys())))
        words = list({w for parts in fresh.values() for w in parts if isinstance(w, str)} - self.words.keys())
        for word, ids in zip(words, self.index.apply([self.start(w) for w in words]), strict=True):
            self.words[word] = packed(array(IDS, ids))
        for chunk, parts in fresh.items():
            if len(parts) == 1 and isinstance(parts[0], str):
                self.chunks[chunk] = self.words[parts[0]]
            else:
                self.chunks[chunk] = b"".join(
                    [self.words[p] if isinstance(p, str) else packed(array(IDS, (p,))) for p in parts]
                )
        out = [b"".join(map(self.chunks.__getitem__, chunks)) for chunks in cut]
        self.forget(fresh, words)
        return out

    def forget(self, chunks, words) -> None:
        """Keep the tables bounded: long keys go at once, all when there are too many."""
        for table, added in ((self.chunks, chunks), (self.words, words)):
            if len(table) > KNOWN_ENTRIES:
                table.clear()
            else:
                for key in added:
                    if len(key) > KNOWN_BYTES:
                        del table[key]


def packed(ids: array) -> bytes:
    if sys.byteorder == "big":
        ids.byteswap()
    return ids.tobytes()


def unpacked(ids: bytes) -> array:
    out = array(IDS)
    out.frombytes(ids)
    if sys.byteorder == "big":
        out.byteswap()
    return out


def encode(
    docs: DataFrame,
    path: str,
    text: str = "text",
    binary: bool = False,
    keep: bool = True,
    decoded: bool = False,
) -> DataFrame:
    """`docs` with `ids`: an array of ids, or `binary` little-endian unsigned 32-bit integers.

    With `decoded`, what `decode` makes of the ids is added in the same pass.
    """
    vocabulary = docs.sparkSession.sparkContext.broadcast(read_vocabulary(path))
    state: list[Encoder] = []

    def compute(texts: list[bytes]) -> list:
        if not state:
            state.append(Encoder(vocabulary.value))
            gc.freeze()
        gc.disable()  # no cycles are made, and looking for them is a third of the work
        ids = state[0].encode(texts)
        gc.enable()
        out = [ids if binary else [unpacked(i).tolist() for i in ids]]
        if decoded:
            out.append(joined_tokens(vocabulary.value["tokens"], map(unpacked, ids)))
        return out

    kind = T.BinaryType() if binary else T.ArrayType(T.IntegerType(), False)
    fields = [T.StructField("ids", kind)] + [T.StructField("decoded", T.StringType())] * decoded
    return map_texts(docs, text, fields, compute, keep)


def joined_tokens(tokens: dict[int, str], rows: Iterable[Iterable[int]]) -> list[str]:
    return [" ".join([tokens[i] for i in row if i in tokens]) for row in rows]


def decode(docs: DataFrame, path: str, ids: str = "ids", keep: bool = True) -> DataFrame:
    """`docs` with `decoded`: the tokens of `ids` (either form), special ones too, between blanks."""
    vocabulary = docs.sparkSession.sparkContext.broadcast(read_vocabulary(path)["tokens"])
    binary = isinstance(docs.schema[ids].dataType, T.BinaryType)

    def compute(rows: list) -> list:
        return [joined_tokens(vocabulary.value, (unpacked(row) if binary else row for row in rows))]

    fields = [T.StructField("decoded", T.StringType())]
    return map_texts(docs, ids, fields, compute, keep, cast=None)
