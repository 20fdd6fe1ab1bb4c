"""Exact byte-level BPE ids for whole texts, in worker processes.

The vocabulary file is a parameter. Ids are those of the `tokenizers` library; texts of plain
characters go through `tiktoken` with the same vocabulary as ranks, which is several times faster and
gives the same ids. A text goes to the library itself if it holds a character outside the ranges below
(the two libraries' tables of letters and digits may differ there), if it may hold a special
string, or if the fast one gives up on it.
"""

from __future__ import annotations

import base64
import os
import re
from functools import cached_property

import numpy as np

VOCABULARY, RANKS = "byte_bpe_50k.json", "byte_bpe_50k.tiktoken"
#: Characters on whose class both libraries agree: Latin, Greek and Cyrillic blocks, general punctuation.
_ODD = re.compile("[^\x00-\x1b\x20-ɏΑ-ΡΣ-ϿА-я‐-‧‰-⁞€]|<\\|")

_made: dict[str, "Encoder"] = {}


def encoder(vocabulary: str = VOCABULARY, ranks: str | None = RANKS) -> "Encoder":
    """One encoder a worker process."""
    key = f"{vocabulary}|{ranks}"
    if key not in _made:
        _made[key] = Encoder(vocabulary, ranks)
    return _made[key]


def _path(name: str) -> str:
    if os.path.isabs(name):
        return name
    import public_tokenizers

    return public_tokenizers.path(name)


class Encoder:
    def __init__(self, vocabulary: str, ranks: str | None):
        self.vocabulary, self.fast = vocabulary, None
        if ranks:
            import public_tokenizers
            import tiktoken

            with open(_path(ranks), "rb") as f:
                table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
            self.fast = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={})

    @cached_property
    def library(self):
        """Loaded where a text first needs it."""
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        return Tokenizer.from_file(_path(self.vocabulary))

    def ids(self, text: str) -> np.ndarray:
        """Ids of a whole text without added specials, as uint32."""
        if self.fast is not None and not _ODD.search(text):
            try:
                return np.asarray(self.fast.encode_to_numpy(text, disallowed_special=()), np.uint32)
            except (BaseException) as e:  # noqa: BLE001  the fast library panics on some very long runs
                if isinstance(e, (KeyboardInterrupt, SystemExit, MemoryError)):
                    raise
        return np.asarray(self.library.encode(text, add_special_tokens=False).ids, np.uint32)

    def count(self, text: str) -> int:
        return len(self.library.encode(text, add_special_tokens=False).ids)
