"""Token ids of texts, in tasks. The vocabulary files are parameters and are never copied."""

from __future__ import annotations

import base64
import json
from array import array
from functools import lru_cache

import public_tokenizers
import tiktoken

#: The vocabulary as its ranks, and the file that defines the tokenizer with its added tokens. Both give the same ids; the
#: ranks do at a quarter of the time.
VOCABULARY = "byte_bpe_50k.tiktoken"
DEFINITION = "byte_bpe_50k.json"


@lru_cache(maxsize=2)
def encoder(name: str = VOCABULARY, definition: str = DEFINITION) -> tiktoken.Encoding:
    """The ranks of a vocabulary. Strings of added tokens are cut out first and have the ids of the definition."""
    with open(public_tokenizers.path(name), "rb") as file:
        ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in file)}
    with open(public_tokenizers.path(definition), encoding="utf-8") as file:
        added = json.load(file)["added_tokens"]
    if any(token[how] for token in added for how in ("single_word", "lstrip", "rstrip", "normalized")):
        raise ValueError(f"{definition} has added tokens that are not plain strings")
    special = {token["content"]: token["id"] for token in added}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special)


def document_ids(text: str | None, end: int = 0, name: str = VOCABULARY) -> array:
    """Ids of a text and the id that ends it. A null text is empty. The string of an added token is that token."""
    text = (text or "").encode("utf-8", "replace").decode("utf-8")
    ids = array("I", encoder(name).encode(text, allowed_special="all"))
    ids.append(end)
    return ids
