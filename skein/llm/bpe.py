"""Byte-level BPE: encoding with offsets and decoding, over Arrow batches.

The merges are done by the tokenizers library. A text is first cut by the vocabulary's own pattern, and each distinct
piece is encoded once in a worker (a bounded cache): the merges never cross pieces, so the ids are those of the whole
text. A byte-level vocabulary writes each byte as one printable character; the table from bytes to characters is made
here by its rule, and its reverse gives every id its bytes. Token offsets are sums of those lengths in bytes, and a
map from bytes to characters turns them into character offsets; a token may begin or end inside a character, which
its offsets then include whole. Decoding joins the bytes of a document's ids, so split characters come together again.

Nulls read as empty texts and give no ids; null ids of rows stay null. Repeated rows give repeated results. An empty table gives none. Other
columns of the input pass through ``encode`` unchanged; its own columns are named by parameters.
"""

from __future__ import annotations

import hashlib
import json
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from skein.llm.text import filled, slices, small_batches

#: Pieces of text whose ids a worker remembers, then starts anew; about 100 MB.
CACHE_PIECES = 400_000
#: Longer pieces are forgotten after the texts they are in.
CACHE_CHARS = 64
#: Pieces that go to the library in one text.
JOINED = 512


def byte_characters() -> dict[int, str]:
    """The printable character that stands for each byte: itself where it is printable Latin-1, else one from 256 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    table = {b: chr(b) for b in own}
    for b in range(256):
        table.setdefault(b, chr(256 + len(table) - len(own)))
    return table


class Codec:
    """Encoder and decoder for one vocabulary file of the tokenizers library."""

    def __init__(self, vocabulary: str, pattern: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(vocabulary)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        self.pattern = regex.compile(pattern)
        self.cache: dict[str, list[int]] = {}
        self.line_break = self.tokenizer.encode_batch_fast(["\n"], add_special_tokens=False)[0].ids[0]
        back = {c: b for b, c in byte_characters().items()}
        special = {t.content for t in self.tokenizer.get_added_tokens_decoder().values()}
        vocab = self.tokenizer.get_vocab()
        self.token_bytes: list[bytes] = [b""] * (max(vocab.values()) + 1)
        for token, i in vocab.items():
            self.token_bytes[i] = token.encode() if token in special else bytes(back[c] for c in token)
        self.lengths = np.array([len(b) for b in self.token_bytes], np.int32)
        self.decimals = [str(i) for i in range(len(self.token_bytes))]

    def _ids_of(self, pieces: list[str]) -> list[list[int]]:
        """The ids of single pieces of the pattern.

        Many go to the library in one text, each on a line: a line break is a piece and a token of its own there, so
        the ids between two are those of a piece. Pieces of white space, or where the count does not agree, go singly.
        """
        out: list[list[int] | None] = [None] * len(pieces)
        lines = [k for k, p in enumerate(pieces) if not p.isspace() and "\n" not in p]
        for lo in range(0, len(lines), JOINED):
            part = lines[lo : lo + JOINED]
            ids = self.tokenizer.encode_batch_fast(["\n".join([pieces[k] for k in part])], add_special_tokens=False)[0].ids
            breaks = [-1, *(i for i, x in enumerate(ids) if x == self.line_break), len(ids)]
            if len(breaks) == len(part) + 1:
                for k, x, y in zip(part, breaks, breaks[1:]):
                    out[k] = ids[x + 1 : y]
        left = [k for k, x in enumerate(out) if x is None]
        for k, e in zip(left, self.tokenizer.encode_batch_fast([pieces[k] for k in left], add_special_tokens=False)):
            out[k] = e.ids
        return out

    def encode(self, texts: list[str]) -> list[list[int]]:
        """The ids of each text."""
        cut = [self.pattern.findall(t) for t in texts]
        long = self._learn(cut)
        made = [list(chain.from_iterable(map(self.cache.__getitem__, c))) for c in cut]
        for p in long:
            del self.cache[p]
        return made

    def _learn(self, cut: list[list[str]]) -> list[str]:
        """Puts the ids of all pieces of the texts into the cache; the long ones among them, which are not to stay."""
        pieces = set(chain.from_iterable(cut))
        if len(self.cache) + len(pieces) > CACHE_PIECES:
            self.cache.clear()
        new = [p for p in pieces if p not in self.cache]
        self.cache.update(zip(new, self._ids_of(new)))
        return [p for p in new if len(p) > CACHE_CHARS]

    def digest(self, texts: list[str]) -> list[tuple[int, str, str, str, int]]:
        """For each text: number of ids; SHA-256 of the ids in decimal joined by spaces, of the bytes that they decode to
        and of their character offsets (all starts, then all ends, as 32-bit numbers); and tokens that begin inside a
        character."""
        out = []
        for text, ids in zip(texts, self.encode(texts)):
            starts, ends, split = self.offsets(text, ids)
            written = " ".join(map(self.decimals.__getitem__, ids))
            sums = [hashlib.sha256(x).hexdigest() for x in (written.encode(), self.decode_bytes(ids), starts.tobytes() + ends.tobytes())]
            out.append((len(ids), *sums, split))
        return out

    def offsets(self, text: str, ids: list[int]) -> tuple[np.ndarray, np.ndarray, int]:
        """Start and end of each token in characters, and how many begin inside one; a character that a token has only in
        part counts whole."""
        n = self.lengths[np.array(ids, np.int64)]
        ends = np.cumsum(n, dtype=np.int32)
        starts = ends - n
        if text.isascii():  # bytes are characters
            return starts, ends, 0
        data = np.frombuffer(text.encode(), np.uint8)
        first = (data & 0xC0) != 0x80
        number = np.zeros(len(data) + 1, np.int32)  # of the character that a byte is part of
        np.cumsum(first[1:], out=number[1:-1])
        number[-1] = number[-2] + 1
        return number[starts], np.where(ends > starts, number[ends - 1] + 1, number[starts]), int(np.count_nonzero(~first[starts]))

    def decode_bytes(self, ids) -> bytes:
        return b"".join(map(self.token_bytes.__getitem__, ids))

    def decode(self, ids) -> str:
        """The text of ids; bytes that are no whole characters become U+FFFD."""
        return self.decode_bytes(ids).decode("utf-8", "replace")


@lru_cache(maxsize=4)
def codec(vocabulary: str, pattern: str) -> Codec:
    return Codec(vocabulary, pattern)


def check_ranks(vocabulary: str, ranks: str) -> None:
    """Error unless a rank file has exactly the tokens and ids of the vocabulary, special tokens aside."""
    import base64

    with open(ranks, "rb") as lines:
        wanted = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    with open(vocabulary, encoding="utf-8") as f:
        model = json.load(f)["model"]["vocab"]
    back = {c: b for b, c in byte_characters().items()}
    has = {bytes(back[c] for c in t): i for t, i in model.items() if all(c in back for c in t)}
    if any(has.get(t) != i for t, i in wanted.items()):
        raise ValueError(f"{ranks} has other tokens than {vocabulary}")


def encode(docs: DataFrame, vocabulary: str, pattern: str, text: str = "text", ids: str = "ids", starts: str = "starts", ends: str = "ends") -> DataFrame:
    """``docs`` with the ids of every text and each token's character offsets; null texts give empty lists.

    A name among ``ids``, ``starts`` and ``ends`` that the input has already is an error.
    """
    _free(docs, ids, starts, ends)
    small_batches(docs.sparkSession)
    schema = T.StructType([*docs.schema.fields, T.StructField(ids, T.ArrayType(T.IntegerType())), *(T.StructField(n, T.ArrayType(T.IntegerType())) for n in (starts, ends))])

    def run(batches):
        own = codec(vocabulary, pattern)
        for piece in slices(batches, text):
            texts = filled(piece.column(text)).to_pylist()
            coded = own.encode(texts)
            spans = [own.offsets(t, i) for t, i in zip(texts, coded)]
            lists = [pa.array(col, pa.list_(pa.int32())) for col in (coded, [s for s, _, _ in spans], [e for _, e, _ in spans])]
            yield pa.RecordBatch.from_arrays([*piece.columns, *lists], names=schema.names)

    return docs.mapInArrow(run, schema)


def decode(frame: DataFrame, vocabulary: str, pattern: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """``frame`` with the text of its ids; null ids give a null text."""
    _free(frame, text)
    small_batches(frame.sparkSession)
    schema = T.StructType([*frame.schema.fields, T.StructField(text, T.StringType())])

    def run(batches):
        own = codec(vocabulary, pattern)
        for batch in batches:
            made = [None if i is None else own.decode(i) for i in batch.column(ids).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(made, pa.string())], names=schema.names)

    return frame.mapInArrow(run, schema)


def digests(docs: DataFrame, vocabulary: str, pattern: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Every text's :meth:`Codec.digest`; ids and offsets stay in the worker."""
    small_batches(docs.sparkSession)

    def run(batches):
        own = codec(vocabulary, pattern)
        for piece in slices(batches, text):
            rows = own.digest(filled(piece.column(text)).to_pylist())
            n, *sums, split = zip(*rows)
            yield pa.RecordBatch.from_arrays([piece.column(doc_id), pa.array(n, pa.int64()), *map(pa.array, sums), pa.array(split, pa.int64())], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "offsets_sha256", "n_split"])

    return docs.select(doc_id, text).mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, offsets_sha256 string, n_split long")


def _free(frame: DataFrame, *names: str) -> None:
    if clash := {n.lower() for n in names} & {c.lower() for c in frame.columns}:
        raise ValueError(f"the input has columns named {sorted(clash)}")


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract of op7: ids of every whole document and the round trip, by digest."""
    import public_tokenizers as tokens

    vocabulary = tokens.path("byte_bpe_50k.json")
    check_ranks(vocabulary, tokens.path("byte_bpe_50k.tiktoken"))
    return digests(spark.read.parquet(f"{sf_dir}/documents.parquet"), vocabulary, tokens.PATTERN)
