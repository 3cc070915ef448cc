"""Token ids of whole texts by a byte-level BPE vocabulary file.

The file's merges become ranks for the compiled encoder of another public
library, which gives the same ids several times faster; a text that it can't
take (runs of millions of spaces) goes to the file's own library.
"""

from __future__ import annotations

import json
import os

import numpy as np
import pyarrow as pa

#: fixed value: the pre-tokeniser that files of this kind mean
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

_ENCODERS: dict[str, "ByteEncoder"] = {}


class ByteEncoder:
    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import tiktoken

        with open(path) as f:
            spec = json.load(f)
        model, pre = spec["model"], spec["pre_tokenizer"] or {}
        if (model["type"] != "BPE" or spec["normalizer"] or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space")
                or not pre.get("use_regex", True) or model.get("dropout") or model.get("ignore_merges")
                or model.get("continuing_subword_prefix") or model.get("end_of_word_suffix")):
            raise ValueError("only byte-level BPE with its own pre-tokeniser and no normaliser is supported")
        added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"]):
            raise ValueError("added tokens that take their surroundings are not supported")
        # the byte-level alphabet: printable bytes stand for themselves, the others follow from 256 on
        own = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [b for b in range(256) if b not in own]
        byte = {**{chr(b): b for b in own}, **{chr(256 + i): b for i, b in enumerate(rest)}}
        ranks = {bytes(byte[c] for c in p): i for p, i in model["vocab"].items() if p not in added}
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        order = [model["vocab"][a + b] for a, b in pairs]
        if any(a >= b for a, b in zip(order, order[1:])) or set(order) | {ranks[bytes([b])] for b in range(256)} != set(ranks.values()):
            raise ValueError("only vocabularies numbered in the order of their merges are supported")
        self.path, self.n_ids = path, max([*ranks.values(), *added.values()]) + 1
        self.encoding = tiktoken.Encoding("bytes", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=added)
        self.library = None

    def ids(self, text: str) -> np.ndarray:
        try:
            return self.encoding.encode_to_numpy(text, allowed_special="all")
        except BaseException as e:
            if type(e).__name__ != "PanicException":
                raise
        if self.library is None:
            from tokenizers import Tokenizer

            self.library = Tokenizer.from_file(self.path)
        return np.array(self.library.encode(text, add_special_tokens=False).ids, np.uint32)

    def encode(self, texts: pa.Array, first: int, last: int, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of texts ``first`` to ``last`` side by side, each closed by ``end_id``, and their offsets."""
        found = [self.ids(t) if t else np.zeros(0, np.uint32) for t in texts.slice(first, last - first).to_pylist()]
        offsets = np.r_[0, np.cumsum([len(x) + 1 for x in found])].astype(np.int64)
        ids = np.full(offsets[-1], end_id, np.uint32)
        inner = np.ones(offsets[-1], bool)
        inner[offsets[1:] - 1] = False
        ids[inner] = np.concatenate(found)
        return ids, offsets


def byte_encoder(path: str) -> ByteEncoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = ByteEncoder(path)
    return _ENCODERS[path]
