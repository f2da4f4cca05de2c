"""Public tokenizer vocabularies, read once by the driver and handed to the tasks as a broadcast.

Each file is a fixed public vocabulary of at most a few MB, so the broadcast doesn't grow with
the data, and executors need no path to the file. Workers keep what they build from it.
"""

from __future__ import annotations

import base64
import hashlib
import json

from pyspark.sql import SparkSession

_built: dict = {}


def default_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def default_pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


class File:
    """A file's bytes as a broadcast variable, and a name for its contents."""

    def __init__(self, spark: SparkSession, path: str):
        with open(path, "rb") as f:
            data = f.read()
        self.id = hashlib.sha256(data).hexdigest()
        self._data = spark.sparkContext.broadcast(data)

    @property
    def value(self) -> bytes:
        return self._data.value


def shared(spark: SparkSession, path: str) -> File:
    return File(spark, path)


def built(key, make):
    """What ``make`` returns, once per worker process and key."""
    if key not in _built:
        _built[key] = make()
    return _built[key]


def rank_file(data: bytes) -> dict[bytes, int]:
    """Token bytes to rank of a ``.tiktoken`` file."""
    return {base64.b64decode(a): int(b) for a, b in map(bytes.split, data.splitlines()) if a}


def byte_alphabet() -> dict[str, int]:
    """The byte behind each character of a byte-level vocabulary: printable bytes stand for
    themselves, the others for the characters from 256 on, in order."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


def byte_level_json(data: bytes) -> dict[bytes, int]:
    """Token bytes to id of a ``tokenizers`` file with a byte-level BPE model, without added tokens.

    Its merges are in id order, so the ids are ranks too (checked here)."""
    file = json.loads(data)
    alphabet, vocab = byte_alphabet(), file["model"]["vocab"]
    added = {t["content"] for t in file.get("added_tokens", ())}
    last = -1
    for merge in file["model"]["merges"]:
        a, b = merge.split(" ") if isinstance(merge, str) else merge
        if vocab[a + b] < last:
            raise ValueError("merges are not in id order: ids are no ranks")
        last = vocab[a + b]
    return {bytes(alphabet[c] for c in token): i for token, i in vocab.items() if token not in added}


def added_tokens(data: bytes) -> dict[str, int] | None:
    """Added tokens of a ``tokenizers`` file, content to id, if texts are simply split at them; else None.

    Not so are tokens that take blanks or word edges into account, go through a normalizer, or start like another one."""
    file = json.loads(data)
    tokens = file.get("added_tokens") or ()
    if any(t.get(k) for t in tokens for k in ("single_word", "lstrip", "rstrip")) or (
            file.get("normalizer") and any(t.get("normalized") for t in tokens)):
        return None
    added = {t["content"]: t["id"] for t in tokens}
    if any(a != b and b.startswith(a) for a in added for b in added):
        return None
    return added


def fields(data: bytes):
    """Fields of a protocol-buffer message: (number, value)."""
    import struct

    at = 0

    def varint():
        nonlocal at
        value = shift = 0
        while True:
            c = data[at]
            at += 1
            value |= (c & 127) << shift
            shift += 7
            if c < 128:
                return value

    while at < len(data):
        key = varint()
        kind = key & 7
        if kind == 0:
            yield key >> 3, varint()
        elif kind == 2:
            n = varint()
            yield key >> 3, data[at:at + n]
            at += n
        else:
            n = 4 if kind == 5 else 8
            yield key >> 3, struct.unpack("<f" if n == 4 else "<d", data[at:at + n])[0]
            at += n


def pieces(data: bytes) -> list[tuple[str, float, int]]:
    """(piece, score, type) of a sentencepiece model, in id order; types: 1 normal, 2 unknown, 3 control, 6 byte."""
    out = []
    for number, value in fields(data):
        if number == 1:
            f = dict(fields(value))
            out.append((f[1].decode(), f.get(2, 0.0), f.get(3, 1)))
    return out
