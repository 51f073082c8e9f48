"""Token ids of whole texts with the vocabulary file of a public tokenizer.

The ids are those of ``tokenizers`` with the same file; the ranks of the same
vocabulary give them faster through ``tiktoken`` (``tests/llm`` compares the two
over whole tables).  A text that tiktoken's splitter gives up on (white space or
one word without end) goes to ``tokenizers`` itself.
"""

from __future__ import annotations

import base64
import os

import numpy as np

END = 2
VOCABULARY = "byte_bpe_50k"

_loaded: dict = {}


def vocabulary_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def encoder(vocabulary: str = VOCABULARY):
    """text -> list of ids, loaded once in a Python worker."""
    if vocabulary not in _loaded:
        import public_tokenizers
        import tiktoken

        with open(vocabulary_path(f"{vocabulary}.tiktoken"), "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        fast = tiktoken.Encoding(vocabulary, pat_str=public_tokenizers.PATTERN,
                                 mergeable_ranks=ranks, special_tokens={})

        def encode(text: str) -> list[int]:
            try:
                return fast.encode_ordinary(text)
            except BaseException as e:  # a panic of the splitter is no Exception
                if isinstance(e, (KeyboardInterrupt, SystemExit, MemoryError)):
                    raise
                return reference_encoder(vocabulary)(text)

        _loaded[vocabulary] = encode
    return _loaded[vocabulary]


def reference_encoder(vocabulary: str = VOCABULARY):
    """The same by ``tokenizers`` alone."""
    key = ("tokenizers", vocabulary)
    if key not in _loaded:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        slow = Tokenizer.from_file(vocabulary_path(f"{vocabulary}.json"))
        slow.encode_special_tokens = True
        _loaded[key] = lambda text: slow.encode(text, add_special_tokens=False).ids
    return _loaded[key]


def document_ids(raw: bytes, vocabulary: str = VOCABULARY, end: int | None = END) -> np.ndarray:
    """Ids of a UTF-8 text, then the end mark."""
    ids = encoder(vocabulary)(raw.decode("utf-8", "replace"))
    if end is not None:
        ids.append(end)
    return np.array(ids, dtype="<u4")
