"""Access to the public tokenizer files inside tasks: pre-tokens and token ids, loaded once per Python worker."""

from __future__ import annotations

import functools
import json

VOCABULARY = "byte_bpe_50k.json"
# The pre-token pattern of byte-level BPE vocabularies of this kind (fixed value).
PRE_TOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def default_path(name: str = VOCABULARY) -> str:
    """The installed file; resolved where it is read, so every executor uses its own copy."""
    import public_tokenizers

    return public_tokenizers.path(name)


@functools.cache
def special_tokens(path: str | None) -> dict[str, int]:
    """Special strings that the library finds inside texts by default, with their ids."""
    with open(path or default_path()) as f:
        return {t["content"]: t["id"] for t in json.load(f)["added_tokens"]}


@functools.cache
def splitter(path: str | None):
    """Function from a text to its pre-tokens (with special strings as pre-tokens of their own)."""
    import regex

    special = "|".join(regex.escape(s) for s in sorted(special_tokens(path), key=len, reverse=True))
    parts, pieces = (regex.compile(f"({special})") if special else None), regex.compile(PRE_TOKEN)

    def split(text: str) -> list[str]:
        if parts is None or not parts.search(text):
            return pieces.findall(text)
        out = []
        for i, part in enumerate(parts.split(text)):
            out += [part] if i % 2 else pieces.findall(part)
        return out

    return split


@functools.cache
def counter(path: str | None):
    """Function from a list of pre-tokens to their numbers of token ids, by the tokenizers library."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path or default_path())

    def count(pre_tokens: list[str]) -> list[int]:
        return [len(e.ids) for e in tokenizer.encode_batch_fast(pre_tokens, add_special_tokens=False)]

    return count


@functools.cache
def encoder(path: str | None):
    """Function from a text to its ids as a numpy array, equal to the tokenizers library's ids for the same vocabulary.

    The merge ranks are read from the vocabulary file itself, so no second
    file is needed; tests compare both libraries on whole texts.
    """
    import tiktoken

    with open(path or default_path()) as f:
        model = json.load(f)["model"]
    special = special_tokens(path)
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    # Byte-level vocabularies write the other bytes as the characters from 256 on.
    byte_of = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in set(shown))}
    ranks = {bytes(byte_of[c] for c in token): i for token, i in model["vocab"].items() if token not in special}
    own = tiktoken.Encoding("vocabulary", pat_str=PRE_TOKEN, mergeable_ranks=ranks, special_tokens=special)
    return lambda text: own.encode_to_numpy(text, allowed_special="all")
