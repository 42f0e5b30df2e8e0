"""Token counts by the whole-token shortcut.

Offline, once in each worker, every vocabulary string is encoded alone; those that give exactly one token
form the whole-token table. The chunks of a batch of texts between white space are told apart in Arrow; each
distinct one is cut into pre-tokens, usually one. Those found in the table (or met lately) are counted
directly, only the rest are merged; every chunk of the texts then points to its ids.

Null text counts as empty; an empty text has 0 tokens; repeated rows give repeated rows; columns other than
``doc_id`` and ``text`` are not read. Texts are never cut.
"""

from __future__ import annotations

import os
import struct
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import public_tokenizers
import regex
from pyspark.sql import DataFrame
from tokenizers import Tokenizer, pre_tokenizers

from cindermill.llm.common import kept, map_batches

# Spark runs a task a core: threads of the tokenizer would add their memory to each worker and no speed.
os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

VOCABULARY = "word_bpe_49k.json"
#: Pre-tokens kept by a worker beside the whole-token table: those met last, and as many met before.
CACHE_ENTRIES = 120_000
#: The pre-token pattern of the vocabulary file.
PRE_TOKENS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
#: Chunks for the tokenizer itself: characters that its normaliser may change, white space beyond ASCII, openings of special strings.
ODD = r"[^\x00-\x{024f}]|[\x1c-\x1f\x{85}\x{a0}\x{130}]|<\|"
#: A run of marks at the end of a chunk is one pre-token.
MARKS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"


@kept
def tokenizer(name: str = VOCABULARY) -> Tokenizer:
    return Tokenizer.from_file(public_tokenizers.path(name))


@kept
def merger(name: str = VOCABULARY) -> Tokenizer:
    """The vocabulary's merges alone, for pre-tokens with a space between: already normalised and cut, they need neither step."""
    t = Tokenizer(tokenizer(name).model)
    t.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
    return t


@kept
def word_ends(name: str = VOCABULARY) -> np.ndarray:
    """True at the ids that end a pre-token; every pre-token has exactly one, its last."""
    t = tokenizer(name)
    return np.array([(t.id_to_token(i) or "").endswith("</w>") for i in range(t.get_vocab_size())])


def byte_characters() -> dict[str, int]:
    """The vocabulary's character of each byte, reversed: printable bytes stand for themselves, the rest follow from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


@kept
def whole_tokens(name: str = VOCABULARY) -> dict[str, int]:
    """Vocabulary strings proven to encode alone as one token, with its id."""
    t, of = tokenizer(name), byte_characters()
    named = [bytes(of[c] for c in s[:-4]).decode(errors="replace") for s in t.get_vocab() if s.endswith("</w>")]
    texts = [s for s in dict.fromkeys(named) if s and PRE_TOKENS.fullmatch(s) and s == s.lower()]
    alone = t.encode_batch_fast(texts, add_special_tokens=False)
    return {s: e.ids[0] for s, e in zip(texts, alone, strict=True) if len(e.ids) == 1}


class Recent(dict):
    """Values by key: a base that stays, the entries met last, and as many met before."""

    def __init__(self, base: dict):
        self.base, self.before = base, {}
        super().__init__(base)

    def unknown(self, keys: set) -> set:
        """Those of ``keys`` without a value; the others are at hand afterwards."""
        if len(self) > len(self.base) + CACHE_ENTRIES:
            self.before = dict(self)
            self.clear()
            self.update(self.base)
        new, before = keys.difference(self), self.before
        if before:
            met = [k for k in new if k in before]
            self.update(zip(met, map(before.__getitem__, met), strict=True))
            new.difference_update(met)
        return new


class Encoded:
    """Texts as entries of a table of ids (bytes, unsigned, 32 bits), with where each text's entries end."""

    def __init__(self, table: list[bytes], entries: np.ndarray, ends: np.ndarray):
        self.table, self.entries = table, entries
        self.sizes = np.fromiter(map(len, table), np.int64, len(table)) // 4
        self.upto = np.concatenate([[0], np.cumsum(self.sizes[entries])])
        self.ends = self.upto[ends]

    def counts(self) -> np.ndarray:
        return np.diff(self.ends, prepend=0)

    def ids(self) -> list[bytes]:
        """The ids of every text."""
        first = np.cumsum(self.sizes) - self.sizes
        kind = np.int32 if self.upto[-1] + len(self.table) < 2**31 and self.sizes.sum() < 2**31 else np.int64
        at = np.repeat((first[self.entries] - self.upto[:-1]).astype(kind), self.sizes[self.entries])
        at += np.arange(self.upto[-1], dtype=kind)
        data, ends = np.frombuffer(b"".join(self.table), "<u4")[at].tobytes(), (4 * self.ends).tolist()
        return [data[a:b] for a, b in zip([0, *ends], ends, strict=False)]


class PreTokens:
    """Encodes texts by batch: chunks are told apart in Arrow, each distinct one is cut, each pre-token not met lately is merged."""

    def __init__(self, name: str):
        self.name, self.tokenizer = name, tokenizer(name)
        self.known = Recent({"": b""} | {s: struct.pack("<I", i) for s, i in whole_tokens(name).items()})

    def encode(self, texts: pa.Array) -> Encoded:
        lists = pc.ascii_split_whitespace(pc.fill_null(texts.cast(pa.string()), ""))  # no token spans two chunks
        words = lists.values.dictionary_encode()
        chunks = words.dictionary
        lower = pc.utf8_lower(chunks)
        letters = pc.utf8_rtrim(lower, characters=MARKS)
        odd = pc.match_substring_regex(chunks, ODD)
        # letters, then perhaps marks: one or two pre-tokens
        plain = pc.and_not(pc.utf8_is_alpha(letters), odd).to_numpy(zero_copy_only=False)
        marked = plain & (pc.binary_length(lower).to_numpy() != pc.binary_length(letters).to_numpy())
        piece = letters.filter(pa.array(plain)).dictionary_encode()
        marks = [x[len(y) :] for x, y in zip(*(c.filter(pa.array(marked)).to_pylist() for c in (lower, letters)), strict=True)]
        mark = {m: i for i, m in enumerate(dict.fromkeys(marks))}
        other = pa.array(~plain)
        cut = [None if o else PRE_TOKENS.findall(x) for o, x in zip(odd.filter(other).to_pylist(), lower.filter(other).to_pylist(), strict=True)]
        whole = iter(self.tokenizer.encode_batch_fast([c for c, x in zip(chunks.filter(other).to_pylist(), cut, strict=True) if x is None], add_special_tokens=False))
        names = [*piece.dictionary.to_pylist(), *mark]
        self.merge(self.known.unknown({*names, *chain.from_iterable(filter(None, cut))}))
        ids = self.known.__getitem__
        rest = [np.array(next(whole).ids, "<u4").tobytes() if x is None else b"".join(map(ids, x)) for x in cut]
        first, second = np.empty(len(chunks), np.int32), np.zeros(len(chunks), np.int32)
        first[plain] = 1 + piece.indices.to_numpy()
        first[~plain] = 1 + len(names) + np.arange(len(rest))
        second[marked] = [1 + len(piece.dictionary) + mark[m] for m in marks]
        index = words.indices.to_numpy()
        del chunks, lower, letters, odd, piece, cut
        return Encoded([b"", *map(ids, names), *rest], np.stack([first[index], second[index]], axis=1).ravel(), 2 * lists.offsets.to_numpy()[1:])

    def merge(self, pieces: set[str]) -> None:
        """Make pre-tokens known."""
        todo = list(pieces)
        lines = [" ".join(todo[i : i + 200]) for i in range(0, len(todo), 200)]
        ids = np.array([i for e in merger(self.name).encode_batch_fast(lines, add_special_tokens=False) for i in e.ids], "<u4")
        ends = (4 * np.flatnonzero(word_ends(self.name)[ids]) + 4).tolist()
        data = ids.tobytes()
        self.known.update((p, data[a:b]) for p, a, b in zip(todo, [0, *ends], ends, strict=False))


@kept
def pre_tokens(name: str = VOCABULARY) -> PreTokens:
    return PreTokens(name)


def count_tokens(docs: DataFrame, vocabulary: str = VOCABULARY, limit: int = 2048) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit for every row of ``docs``; one narrow pass, no shuffle."""

    def count(batch):
        n = pre_tokens(vocabulary).encode(batch.column(1)).counts()
        return {"doc_id": batch.column(0), "n_bytes": pc.fill_null(pc.binary_length(batch.column(1)), 0), "n_tokens": n, "over_limit": n > limit}

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_batches(docs.select("doc_id", "text"), count, f"doc_id {kind}, n_bytes long, n_tokens long, over_limit boolean")
