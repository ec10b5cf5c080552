"""Byte-level BPE of texts of any length, exactly as the tokenizers library encodes them.

Texts up to ``piece_chars`` are encoded where they lie. Longer ones are cut into pieces that are
encoded in parallel as rows of their own and put together pairwise, as a tree: around each join a
window is encoded again, and grows until its two ends agree with the two sides.

Null text counts as empty and has no ids. Rows are neither merged nor dropped: repeated rows and
repeated keys each keep their own result; other columns are not looked at.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

PIECE_CHARS = 65_536
WINDOW = 32

# --- fixed values: what byte-level pre-tokenization takes as one pre-token ---------
PRE_TOKENS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: The same where white space never stands next to white space; needs no look-ahead.
SINGLE_SPACED = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s"

_SPACES = re.compile(r"\s\s")
_encoders: dict[str, Encoder] = {}


class Encoder:
    """The tokenizer of a file.

    Merging by rank (tiktoken) is several times faster than the tokenizers library and gives the
    same ids when ids follow the merge order and every token, taken alone, encodes to itself: a pair
    that would make a token by another merge than its own would then also arise in that token alone.
    Both are checked when the file is read; a file that fails is left to the tokenizers library.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        byte_of = _bytes_of_characters()
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.tokens = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            self.tokens[i] = bytes(byte_of[c] for c in token) if all(c in byte_of for c in token) else token.encode()
        added = {i: a.content for i, a in self.tokenizer.get_added_tokens_decoder().items()}
        self.tokens = [added[i].encode() if i in added else t for i, t in enumerate(self.tokens)]
        self.marks = list(added.values())
        self.widths = np.array([len(t) for t in self.tokens], np.int64)
        self.by_rank = None
        if self._follows_ranks(path, vocabulary, added):
            import tiktoken

            ranks = {t: i for i, t in enumerate(self.tokens) if i not in added}
            special = {content: i for i, content in added.items()}
            self.by_rank = [
                tiktoken.Encoding(f"{path} {n}", pat_str=pattern, mergeable_ranks=ranks, special_tokens=special)
                for n, pattern in enumerate((SINGLE_SPACED, PRE_TOKENS))
            ]

    def _follows_ranks(self, path: str, vocabulary: dict[str, int], added: dict[int, str]) -> bool:
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        pre, model = spec["pre_tokenizer"] or {}, spec["model"]
        plain = (
            pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space") and pre.get("use_regex", True)
            and spec["normalizer"] is None and not model.get("ignore_merges") and not model.get("dropout")
            and not any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"])
        )
        pairs = (m if isinstance(m, list) else m.split(" ") for m in model["merges"])
        return plain and all(vocabulary["".join(m)] == 256 + i for i, m in enumerate(pairs)) and all(
            len(self.tokenizer.model.tokenize(t)) == 1 for t, i in vocabulary.items() if i not in added
        )

    def whole(self, text: str) -> np.ndarray:
        """Ids of one text."""
        if self.by_rank is None:
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.int32)
        pick = self.by_rank[bool(_SPACES.search(text))]
        return pick.encode_to_numpy(text, allowed_special="all").astype(np.int32)

    def long(self, text: str, piece_chars: int = PIECE_CHARS) -> np.ndarray:
        """Ids of one text of any length, by the tree inside one task."""
        if len(text) <= piece_chars:
            return self.whole(text)
        parts = [text[i : i + piece_chars] for i in range(0, len(text), piece_chars)]
        return tree(self, parts, [self.whole(p) for p in parts])

    def decode(self, ids: np.ndarray) -> str:
        return b"".join(map(self.tokens.__getitem__, ids.tolist())).decode("utf-8", "replace")


def _bytes_of_characters() -> dict[str, int]:
    """The printable character that byte-level vocabularies write for each byte, reversed."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def vocabulary_file(name: str = "byte_bpe_50k.json") -> str:
    """Path of a public tokenizer's file; it has to be installed on every executor."""
    import public_tokenizers

    return public_tokenizers.path(name)


def encoder(path: str) -> Encoder:
    """The worker's encoder of a file."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


# --- the tree ---------------------------------------------------------------------


def _kind(c: str) -> str:
    return "l" if c.isalpha() else "n" if c.isdigit() else "s" if c.isspace() else "o"


def _free_cut(enc: Encoder, left: str, right: str) -> bool:
    """Whether no token can reach over this place, whatever stands further away."""
    if not left or not right:
        return True
    a, b = left[-1], right[0]
    if not (a.isascii() and b.isascii()) or a.isspace() or a == "'" or _kind(a) == _kind(b) or "\x1c" <= b <= "\x1f":
        return False
    near = max(map(len, enc.marks), default=1) - 1
    around = left[len(left) - near :] + right[:near] if near else ""
    return not any(m in around for m in enc.marks)


def join(enc: Encoder, left: str, left_ids: np.ndarray, right: str, right_ids: np.ndarray) -> np.ndarray:
    """Ids of ``left + right`` from the ids of both.

    The window has ``w`` tokens of each side. An end is settled where the text ends, where no token
    can cross, or where the window's outermost two tokens are those of the side: neighbours that the
    side already has next to each other stay so. Until both ends are settled ``w`` doubles.
    """
    if _free_cut(enc, left, right):
        return np.concatenate([left_ids, right_ids])
    lb, rb = left.encode(), right.encode()
    l_ends, r_ends = np.cumsum(enc.widths[left_ids]), np.cumsum(enc.widths[right_ids])
    w = WINDOW
    while True:
        i, j = max(0, len(left_ids) - w), min(len(right_ids), w)
        a = int(l_ends[i - 1]) if i else 0
        while i and lb[a] & 0xC0 == 0x80:  # not inside a character
            i -= 1
            a = int(l_ends[i - 1]) if i else 0
        b = int(r_ends[j - 1]) if j else 0
        while j < len(right_ids) and rb[b] & 0xC0 == 0x80:
            j += 1
            b = int(r_ends[j - 1])
        middle = enc.whole((lb[a:] + rb[:b]).decode())
        before = i == 0 or np.array_equal(middle[:2], left_ids[i : i + 2]) and len(left_ids) - i >= WINDOW
        after = j == len(right_ids) or np.array_equal(middle[-2:], right_ids[j - 2 : j]) and j >= WINDOW
        if not before:
            before = _free_cut(enc, lb[:a].decode()[-64:], lb[a:].decode()[:64])
        if not after:
            after = _free_cut(enc, rb[:b].decode()[-64:], rb[b:].decode()[:64])
        if before and after:
            return np.concatenate([left_ids[:i], middle, right_ids[j:]])
        w *= 2


def tree(enc: Encoder, texts: list[str], ids: list[np.ndarray]) -> np.ndarray:
    """Join neighbours until one is left."""
    while len(texts) > 1:
        pairs = range(0, len(texts) - 1, 2)
        joined = [join(enc, texts[k], ids[k], texts[k + 1], ids[k + 1]) for k in pairs]
        rest = slice(len(texts) - len(texts) % 2, None)
        ids = joined + ids[rest]
        texts = [texts[k] + texts[k + 1] for k in pairs] + texts[rest]
    return ids[0]


# --- Spark ------------------------------------------------------------------------


def encode_column(text: Column | str, path: str) -> Column:
    """Ids of each text, in place."""

    @F.pandas_udf("array<int>")
    def ids(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        enc = encoder(path)
        for texts in batches:
            yield pd.Series([enc.whole(t) for t in texts.fillna("")], dtype=object)

    return ids.asNondeterministic()(text)


def decode_column(ids: Column | str, path: str) -> Column:
    """Text of each array of ids; null for a null array."""

    @F.pandas_udf("string")
    def text(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        enc = encoder(path)
        for arrays in batches:
            yield arrays.map(lambda a: None if a is None else enc.decode(a))

    return text(ids)


def _encode_pieces(path: str):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc = encoder(path)
        for df in batches:
            yield df.assign(ids=pd.Series([enc.whole(t) for t in df["piece"]], index=df.index, dtype=object))

    return run


def _join_pieces(path: str):
    def run(key: tuple, df: pd.DataFrame) -> pd.DataFrame:
        df = df.sort_values("no", kind="stable")
        copies = int((df["no"] == 0).sum())
        one = df.drop_duplicates("no")
        ids = tree(encoder(path), one["piece"].tolist(), one["ids"].tolist())
        return pd.DataFrame({"key": [key[0]] * copies, "ids": [ids] * copies})

    return run


def encode(docs: DataFrame, key: str, text: str, path: str, piece_chars: int = PIECE_CHARS) -> DataFrame:
    """``key, ids`` of every row. Rows that agree in key and text share their pieces and are given back as often as they came."""
    # Keys go through Python as text: numbers with nulls among them would lose digits there.
    rows = docs.select(F.col(key).cast("string").alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    short = rows.where(F.length("text") <= piece_chars).select("key", encode_column("text", path).alias("ids"))
    starts = F.sequence(F.lit(0), F.floor((F.length("text") - 1) / piece_chars).cast("int"))
    pieces = (
        rows.where(F.length("text") > piece_chars)
        .select("key", F.sha2("text", 256).alias("digest"), "text", F.explode(starts).alias("no"))
        .select("key", "digest", "no", F.expr(f"substring(text, no * {piece_chars} + 1, {piece_chars})").alias("piece"))
    )
    schema = T.StructType([*pieces.schema.fields, T.StructField("ids", T.ArrayType(T.IntegerType()))])
    many = pieces.repartition(F.col("key"), F.col("digest"), F.col("no")).mapInPandas(_encode_pieces(path), schema)
    joined = many.groupBy("key", "digest").applyInPandas(_join_pieces(path), T.StructType([rows.schema["key"], schema["ids"]]))
    return short.unionByName(joined).select(F.col("key").cast(docs.schema[key].dataType).alias(key), "ids")
