"""Token counts with a whole-token shortcut; also the token ids that packing uses."""

from __future__ import annotations

import json
import re
import struct
from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftmill.llm.common import table

TOKENIZER = "byte_bpe_50k.json"
#: Letters and numbers, from ranges where Python's tables and the library's agree: Latin, Greek, Cyrillic, Hebrew, Arabic,
#: kana, the CJK ideographs and Hangul.
_L = "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\u024f\u0386\u0388-\u038a\u038c\u038e-\u03a1\u03a3-\u03f5\u03f7-\u0481\u048a-\u0523\u05d0-\u05ea\u0621-\u063a\u0641-\u064a\u3041-\u3096\u30a1-\u30fa\u30fc-\u30fe\u4e00-\u9fa5\uac00-\ud7a3"
_N = "0-9\xb2\xb3\xb9\xbc-\xbe"
#: Neither letters, numbers nor white space: common signs, arrows, CJK punctuation and the older emoji.
_SIGNS = "\u2010-\u2027\u2030-\u205e\u20a0-\u20b5\u2190-\u21ff\u2600-\u2685\u3001-\u3003\u3008-\u3011\uff01-\uff0f\uff1a-\uff20\ufe0f\U0001f300-\U0001f320\U0001f400-\U0001f43e\U0001f600-\U0001f610\U0001f680-\U0001f6c5"
#: The split of byte-level BPE, for texts without UNSURE characters.
PIECES = re.compile(rf" ?[{_L}]+| ?[{_N}]+|'(?:s|t|re|ve|m|ll|d)| ?[^\s{_L}{_N}]+|\s+(?!\S)|\s+")
#: Texts with other characters than these go to the library whole.
UNSURE = re.compile(f"[^\t-\r\x20-\x7e\xa0-\u024f{_L}{_SIGNS}]")
#: A worker's memory of pieces is emptied at so many; pieces above LONG characters are never remembered, so it is bounded in bytes too.
REMEMBERED, LONG = 400_000, 64


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


@lru_cache(maxsize=4)
def prove_whole(path: str) -> tuple[str, dict[str, int]]:
    """The tokenizer's own JSON, and those vocabulary strings that the library, given the string alone, encodes as one
    token, with its id. Strings that merges can't reach alone, or that are split before merging, fail the test."""
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(path)
    ids = range(tok.get_vocab_size())
    strings = [s for s in tok.decode_batch([[i] for i in ids], skip_special_tokens=False) if s and "�" not in s]
    return tok.to_str(), {s: e.ids[0] for s, e in zip(strings, tok.encode_batch(strings, add_special_tokens=False), strict=True) if len(e.ids) == 1}


@lru_cache(maxsize=4)
def merge_order(spec: str) -> dict[bytes, int] | None:
    """The id of every token by its bytes, single bytes first and then by merge. None if the file is no plain byte-level
    BPE, or if some token's bytes, merged alone by the file's own pairs, don't become that token.

    If all do, merging whatever adjoining tokens form the earliest token gives what the file's pairs give: two tokens
    that form a third were made from its bytes alone, so the state is one that the third token's own merging goes through."""
    file = json.loads(spec)
    model, before = file["model"], file.get("pre_tokenizer") or {}
    plain = model.get("type") == "BPE" and not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges"))
    if not plain or file.get("normalizer") or before.get("type") != "ByteLevel" or before.get("add_prefix_space") or not before.get("use_regex", True):
        return None
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    byte = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(sorted(set(range(256)) - set(shown)))}
    merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
    rank = {m: i for i, m in enumerate(merges)}
    tokens = sorted(byte, key=byte.get) + [a + b for a, b in merges]
    if len(set(tokens)) < len(tokens) or set(tokens) != set(model["vocab"]):
        return None

    def alone(token: str) -> bool:
        parts = list(token)
        while len(parts) > 1:
            low, at = min((rank.get(pair, len(rank)), i) for i, pair in enumerate(zip(parts, parts[1:], strict=False)))
            if low == len(rank):
                return False
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return True

    return {bytes(map(byte.get, t)): model["vocab"][t] for t in tokens} if all(map(alone, tokens)) else None


class Encoder:
    """Encodes texts piece by piece. ``known`` maps a piece to its token ids as little-endian unsigned 32-bit bytes.

    Only pieces that are no whole token and were not met lately are merged. A piece that stands alone is split and
    merged as it is within a text: no piece but white space looks beyond its end, and white space alone gives itself."""

    def __init__(self, spec: str, whole: dict[str, int], order: dict[bytes, int] | None = None):
        from tokenizers import Tokenizer

        order = order or merge_order(spec)
        self.tok = Tokenizer.from_str(spec)
        self.whole = {s: struct.pack("<I", i) for s, i in whole.items()}
        added = self.tok.get_added_tokens_decoder()
        self.special = {t.content: struct.pack("<I", i) for i, t in added.items()}
        self.cut = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.plain = order is not None and all(not (t.lstrip or t.rstrip or t.single_word or t.normalized) for t in added.values())
        merge = self.merger(order) if self.plain else self.library
        encoder = self

        class Known(dict):
            def __missing__(self, piece: str) -> bytes:
                ids = merge(piece)
                if len(piece) <= LONG:
                    if len(self) > len(encoder.whole) + REMEMBERED:
                        self.clear()
                        self.update(encoder.whole)
                    self[piece] = ids
                return ids

        self.known = Known(self.whole)

    @staticmethod
    def merger(order: dict[bytes, int]) -> Callable[[str], bytes]:
        import tiktoken

        ids = [struct.pack("<I", i) for i in order.values()]
        merge = tiktoken.Encoding("merges", pat_str=r"(?s:.+)", mergeable_ranks={t: i for i, t in enumerate(order)}, special_tokens={}).encode_ordinary
        return lambda piece: b"".join([ids[i] for i in merge(piece)])

    def library(self, text: str) -> bytes:
        ids = self.tok.encode(text, add_special_tokens=False).ids
        return struct.pack(f"<{len(ids)}I", *ids)

    def encode(self, text: str) -> bytes:
        if not self.plain or UNSURE.search(text):
            return self.library(text)
        look = self.known.__getitem__
        if self.cut and any(s in text for s in self.special):
            return b"".join(self.special.get(part) or b"".join(map(look, PIECES.findall(part))) for part in self.cut.split(text))
        return b"".join(map(look, PIECES.findall(text)))


_encoders: dict[int, Encoder] = {}


def shared_encoder(spark: SparkSession, path: str | None):
    """What the tasks' encoders are made of, proven on the driver and broadcast: its size is the vocabulary's."""
    spec, whole = prove_whole(path or default_path())
    return spark.sparkContext.broadcast((spec, whole, merge_order(spec)))


def encoder(shared) -> Encoder:
    """This worker's encoder for a ``shared_encoder``."""
    value = shared.value
    key = hash(value[0])
    if key not in _encoders:
        _encoders.clear()
        _encoders[key] = Encoder(*value)
    return _encoders[key]


def per_text(shared) -> Callable[[pa.Array], Iterator[bytes]]:
    enc = encoder(shared)
    return lambda texts: (enc.encode(t.as_py() or "") for t in texts)


def count_tokens(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", limit: int = 512, path: str | None = None) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_bytes, n_tokens, over_limit``; nothing is shuffled.

    Counts are the library's, without added tokens; special strings in a text count as its special tokens. Null and
    empty texts have 0 tokens. Ids are passed on as they are, nulls and repeats included; an empty table gives no
    rows; other columns are not read. The vocabulary (a bounded file) is broadcast, texts never leave their tasks."""
    shared = shared_encoder(docs.sparkSession, path)

    def run(batches):
        encode = per_text(shared)
        for b in batches:
            n = pa.array((len(ids) // 4 for ids in encode(b["text"])), pa.int64())
            size = pc.fill_null(pc.binary_length(b["text"]), 0).cast(pa.int64())
            yield pa.RecordBatch.from_arrays([b["doc_id"], size, n, pc.greater(n, limit)], ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents"))
