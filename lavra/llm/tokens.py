"""Sizes of texts in tokens of a public tokenizer, whose file is a parameter."""

from __future__ import annotations

import ast
import base64
import os
import re

from pyspark.sql import DataFrame

from lavra.runtime import map_batches

#: A byte-level vocabulary for many languages; the folder holds the splitting pattern too.
TOKENIZER = os.environ.get("LAVRA_TOKENIZER", "/opt/tokenizers/byte_bpe_multi_50k.tiktoken")
_loaded: dict = {}
#: White space as the splitting pattern knows it.
_LONG_SPACE = re.compile("[\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000]{500,}")


def splitting_pattern(file: str) -> str:
    """The value given to ``PATTERN`` in a file, read as data."""
    with open(file, encoding="utf-8") as f:
        for node in ast.parse(f.read()).body:
            if isinstance(node, ast.Assign) and any(isinstance(t, ast.Name) and t.id == "PATTERN" for t in node.targets):
                return ast.literal_eval(node.value)
    raise ValueError(f"no PATTERN in {file}")


def encoder(path: str = TOKENIZER):
    """The tokenizer of a ``.tiktoken`` file, loaded once a process."""
    if path not in _loaded:
        import tiktoken

        pattern = splitting_pattern(os.path.join(os.path.dirname(path), "__init__.py"))
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        _loaded[path] = tiktoken.Encoding("lavra", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    return _loaded[path]


def encode(text: str, path: str = TOKENIZER) -> list[int]:
    """The tokens of a text of any length.

    The splitting pattern makes one piece of a run of white space but for the last character before other text; very long
    runs, at which its backtracking runs out of stack, are encoded as that piece directly.
    """
    enc, out, at = encoder(path), [], 0
    for m in _LONG_SPACE.finditer(text):
        end = m.end() - (m.end() < len(text))
        out += enc.encode_ordinary(text[at : m.start()])
        out += enc._encode_single_piece(text[m.start() : end])
        at = end
    return out + enc.encode_ordinary(text[at:])


def token_counts(documents: DataFrame, keep: list[str], path: str = TOKENIZER) -> DataFrame:
    """Columns ``keep`` of ``documents`` (with ``text``) plus ``tokens``; null texts have none."""
    types = dict(documents.dtypes)

    def run(batches):
        for *columns, texts in batches:
            yield *columns, [len(encode(t, path)) if t else 0 for t in texts]

    return map_batches(documents.select(*keep, "text"), run, ", ".join(f"{k} {types[k]}" for k in keep) + ", tokens long")
