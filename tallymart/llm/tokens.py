"""Token ids of whole texts with a public byte-level BPE, a bounded cache of words in each worker.

The rank file of the vocabulary is the faster one. It does not know the added tokens of the tokenizer file,
which that finds inside of texts: a text that holds one is left to the tokenizer file.
"""

from __future__ import annotations

import base64
import json
import os
import sys
import types
from collections.abc import Callable

VOCABULARY = "byte_bpe_50k.tiktoken"
#: Words whose ids a worker keeps.
CACHED_WORDS = 200_000
#: White space other than a space and a line feed.
OTHER_SPACE = ("\t\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005"
               "\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000")


class _Words(dict):
    """Ids, as little-endian unsigned 32-bit bytes, of a word after a space."""

    def __init__(self, encode: Callable[[str], bytes]):
        super().__init__()
        self.encode = encode

    def __missing__(self, word: str) -> bytes:
        if len(self) >= CACHED_WORDS:
            self.clear()
        ids = self[word] = self.encode(" " + word)
        return ids


def encoder(vocabulary: str = VOCABULARY) -> Callable[[str], bytes]:
    """Text to ids as little-endian unsigned 32-bit bytes.

    No token of this vocabulary reaches past a space between two other characters, so a text may be
    cut before each such space and its words looked up. A text with other white space or with white
    space next to a space is encoded as a whole.
    """
    # Modules of this package travel with each task; the cache has to outlive it.
    home = sys.modules.setdefault("_corpus_token_cache", types.ModuleType("_corpus_token_cache"))
    if vocabulary in home.__dict__:
        return home.__dict__[vocabulary]

    import numpy as np
    import public_tokenizers
    import tiktoken

    with open(public_tokenizers.path(vocabulary), "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    bpe = tiktoken.Encoding("corpus", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                            special_tokens={})

    library_file = public_tokenizers.path(vocabulary.removesuffix(".tiktoken") + ".json")
    added = []
    if os.path.exists(library_file):
        with open(library_file, encoding="utf-8") as file:
            added = [token["content"] for token in json.load(file)["added_tokens"]]
    library = []

    def by_library(text: str) -> bytes:
        if not library:  # few texts need it
            import tokenizers

            library.append(tokenizers.Tokenizer.from_file(str(library_file)))
        return np.array(library[0].encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def plain(text: str) -> bytes:
        return np.array(bpe.encode_ordinary(text), "<u4").tobytes()

    words = _Words(plain)

    def encode(text: str) -> bytes:
        if any(token in text for token in added):
            return by_library(text)
        if ("  " in text or " \n" in text or "\n " in text or text[:1].isspace()
                or text[-1:].isspace() or any(c in text for c in OTHER_SPACE)):
            return plain(text)
        first, *rest = text.split(" ")
        return plain(first) + b"".join(map(words.__getitem__, rest))

    home.__dict__[vocabulary] = encode
    return encode
