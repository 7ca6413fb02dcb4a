"""Token ids of a byte-level BPE whose vocabulary file is that of the ``tokenizers`` library.

Where the file's ids follow its merges, as in the usual files, ``tiktoken`` encodes with the very same
vocabulary, several times as fast; other files, texts that hold one of the file's added tokens and texts that it refuses go through ``tokenizers``.
"""

from __future__ import annotations

import json
import os

import numpy as np

# Fixed value: the pre-token pattern of the ByteLevel pre-tokenizer.
PRE_TOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def byte_letters() -> dict[str, int]:
    """The letters that byte-level files write for bytes: printable ones stand for themselves, the others follow from 256 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [byte for byte in range(256) if byte not in shown]
    return {chr(byte): byte for byte in shown} | {chr(256 + k): byte for k, byte in enumerate(hidden)}


def ranks_of(data: dict) -> dict[bytes, int] | None:
    """Token bytes to ids of a tokenizer file, or None if it is not a plain byte-level BPE with ids in the order of its merges."""
    model, pre = data.get("model", {}), data.get("pre_tokenizer") or {}
    if model.get("type") != "BPE" or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or data.get("normalizer"):
        return None
    letters = byte_letters()
    special = {token["content"] for token in data.get("added_tokens", [])}
    ranks = {bytes(letters[c] for c in token): number for token, number in model["vocab"].items() if token not in special}
    last = -1
    for merge in model["merges"]:
        left, right = merge.split(" ") if isinstance(merge, str) else merge
        number = model["vocab"][left + right]
        if number <= last:
            return None
        last = number
    return ranks


class Codes:
    """``encode`` gives a text's ids as little-endian unsigned 32-bit numbers, those of ``Tokenizer.encode(text, add_special_tokens=False)``.

    So an added token's string in a text is that token.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.path = path
        self._slow = None
        self._fast = None
        with open(path, encoding="utf-8") as file:
            data = json.load(file)
        self._added = [token["content"] for token in data.get("added_tokens", [])]
        ranks = ranks_of(data)
        del data
        if ranks:
            import tiktoken

            self._fast = tiktoken.Encoding("byte-bpe", pat_str=PRE_TOKEN, mergeable_ranks=ranks, special_tokens={})

    @property
    def tokenizer(self):
        if self._slow is None:
            from tokenizers import Tokenizer

            self._slow = Tokenizer.from_file(self.path)
        return self._slow

    def ids(self, text: str) -> list[int]:
        if self._fast is not None and not any(token in text for token in self._added):
            try:
                return self._fast.encode_ordinary(text)
            except BaseException as error:
                # The encoder's own pattern engine gives up on some texts, as on very long white space.
                if type(error).__name__ != "PanicException" and not isinstance(error, ValueError):
                    raise
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def encode(self, text: str) -> bytes:
        return np.array(self.ids(text), dtype="<u4").tobytes()

    def count(self, text: str) -> int:
        return len(self.ids(text))
