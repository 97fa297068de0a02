"""Public tokenizers, loaded in tasks from files that are named by path."""

from __future__ import annotations

import base64
from functools import lru_cache

import public_tokenizers

#: Byte-level BPE, once as the tokenizer's own file and once as ranks of the same vocabulary.
BYTE_BPE_JSON = public_tokenizers.path("byte_bpe_50k.json")
BYTE_BPE_RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
BYTE_BPE_SPECIAL = {"<|endoftext|>": 50256}
PIECE_BPE = public_tokenizers.path("piece_bpe_32k.model")


@lru_cache(maxsize=2)
def byte_bpe(path: str = BYTE_BPE_RANKS):
    """``text -> uint32 ids`` of the byte-level BPE.

    Reads the rank form of the vocabulary, several times faster than the JSON
    form; both give the same ids for every code point (``tests/llm``). The
    special string inside a text is its special id, as the JSON form has it.
    """
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(word): int(rank) for word, rank in map(bytes.split, lines)}
    encoding = tiktoken.Encoding(
        "byte_bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=BYTE_BPE_SPECIAL
    )
    return lambda text: encoding.encode_to_numpy(text, allowed_special="all")


@lru_cache(maxsize=2)
def piece_bpe(path: str = PIECE_BPE):
    """The sentence-piece processor of a model file."""
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path)
