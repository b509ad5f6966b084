"""A byte-level BPE vocabulary file: its strings, its ranks and its way of cutting texts."""

from __future__ import annotations

import json
from dataclasses import dataclass
from functools import cached_property, lru_cache
from pathlib import Path

import numpy as np
import public_tokenizers
import regex
import tiktoken

DEFAULT = "byte_bpe_50k.json"
# White space from which on the library's own cutting, which backtracks, is not used.
LONG_SPACE = 10_000
_SPACE = regex.compile(r"\s+")


def _byte_alphabet() -> dict[str, int]:
    """The printable character that stands for each byte in such files."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + k): b for k, b in enumerate(rest)}


@dataclass(frozen=True)
class Vocabulary:
    """Ranks of byte strings and ids of the strings that are taken whole wherever they occur."""

    ranks: dict[bytes, int]
    specials: dict[str, int]

    @cached_property
    def pre_token(self) -> regex.Pattern:
        return regex.compile(public_tokenizers.PATTERN)

    @cached_property
    def special(self) -> regex.Pattern | None:
        if not self.specials:
            return None
        longest_first = sorted(self.specials, key=len, reverse=True)
        return regex.compile("|".join(map(regex.escape, longest_first)))

    @cached_property
    def encoding(self) -> tiktoken.Encoding:
        return tiktoken.Encoding(
            "vocabulary",
            pat_str=public_tokenizers.PATTERN,
            mergeable_ranks=self.ranks,
            special_tokens=self.specials,
        )

    def merged(self, pre_token: str) -> list[int]:
        """The ids of a pre-token, which is not cut any more, however long it is."""
        return self.encoding._encode_single_piece(pre_token)

    def encode(self, text: str) -> np.ndarray:
        """The ids of a text; special strings in it are one id each."""
        if len(text) < LONG_SPACE or max(map(len, _SPACE.findall(text)), default=0) < LONG_SPACE:
            return self.encoding.encode_to_numpy(text, allowed_special="all")
        found = [] if self.special is None else list(self.special.finditer(text))
        ids, at = [], 0
        for match in [*found, None]:
            part = text[at : match.start()] if match else text[at:]
            for pre_token in self.pre_token.findall(part):
                ids += self.merged(pre_token)
            if match:
                ids.append(self.specials[match[0]])
                at = match.end()
        return np.array(ids, np.uint32)


def default_path() -> str:
    return str(public_tokenizers.path(DEFAULT))


@lru_cache(maxsize=4)
def load(path: str) -> Vocabulary:
    """Read a tokenizer file; once per process.

    Ids must follow the order of the merges, as the merge ranks do.
    """
    content = json.loads(Path(path).read_text(encoding="utf-8"))
    alphabet = _byte_alphabet()
    specials = {t["content"]: t["id"] for t in content["added_tokens"]}
    ranks = {
        bytes(alphabet[c] for c in string): rank
        for string, rank in content["model"]["vocab"].items()
        if string not in specials
    }
    merges = content["model"]["merges"]
    pairs = [m.split(" ") if isinstance(m, str) else m for m in merges]
    made = [ranks[bytes(alphabet[c] for c in left + right)] for left, right in pairs]
    if made != sorted(made):
        raise ValueError(f"{path}: ids do not follow the order of merges")
    return Vocabulary(ranks, specials)
