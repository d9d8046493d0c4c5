"""Tokenizers of public vocabulary files, and where a text may be cut without changing its tokens.

A cut is safe before a plain space that follows a character which is neither
white space nor the mark that some models write for it, if no token can hold the two: the tokenizer splits there first, or no
entry of its vocabulary has a space after another character.
"""

from __future__ import annotations

import json
import re

#: Pieces between safe cuts: white space, and all up to a space after another character.
SPACED = re.compile(r"[\s▁]*[^\s▁]+(?:(?:[^\S ]|▁)[\s▁]*[^\s▁]*)*|[\s▁]+")
CUT = re.compile(r"[^\s▁](?= )")
#: Steps of a tokenizer's file that no space is merged across.
NORMALIZERS = {None, "NFC", "Replace", "Lowercase"}


def path(name: str, folder: str | None = None) -> str:
    if folder:
        return f"{folder}/{name}"
    import public_tokenizers

    return public_tokenizers.path(name)


def spaced(text: str) -> list[str]:
    """``text`` in pieces between its safe cuts."""
    return SPACED.findall(text)


def parts(text: str, size: int) -> list[str]:
    """``text`` in parts of about ``size`` characters between safe cuts; a longer run without one stays whole."""
    out, start = [], 0
    while len(text) - start > size and (m := CUT.search(text, start + size)):
        out.append(text[start:m.end()])
        start = m.end()
    return [*out, text[start:]]


class Pieces:
    """A sentencepiece model. Where a text is cut, the space that the model adds stands for the one that is left out."""

    def __init__(self, file: str):
        from sentencepiece import SentencePieceProcessor

        self.model = SentencePieceProcessor(model_file=file)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.bytes = [bytes([int(p[3:5], 16)]) if re.fullmatch("<0x[0-9A-F]{2}>", p) else p.replace("▁", " ").encode() for p in pieces]
        self.safe = not any(re.search("[^▁]▁", p) for p in pieces) and self.model.normalize("a  b ") == "▁a▁▁b▁"
        self.space = self.model.encode("a ")[len(self.model.encode("a")):]  # a last space by itself

    def encode(self, texts: list[str]) -> list[list[int]]:
        """Ids of whole texts."""
        return self.model.encode(texts, num_threads=1)

    def continued(self, pieces: list[str]) -> list[list[int]]:
        """Ids of pieces that start with a space which belongs to the text."""
        return [ids if piece != " " else self.space for piece, ids in zip(pieces, self.encode([p[1:] for p in pieces]), strict=True)]


class Merges:
    """A tokenizer file; ``safe`` tells whether texts may be cut, ``words`` whether each word of the byte-level split stands alone."""

    def __init__(self, file: str):
        from tokenizers import Tokenizer

        with open(file, encoding="utf-8") as f:
            spec = json.load(f)
        self.model = Tokenizer.from_file(file)
        self.model.no_truncation()
        self.model.no_padding()
        steps = lambda s, inner: [x for y in s[inner] for x in steps(y, inner)] if s and s["type"] == "Sequence" else [s or {}]
        normal, split = steps(spec["normalizer"], "normalizers"), steps(spec["pre_tokenizer"], "pretokenizers")
        self.added = [t["content"] for t in spec["added_tokens"]]
        plain = all(not re.search(r"\s", t["content"]) and not (t["lstrip"] or t["rstrip"] or t["normalized"]) for t in spec["added_tokens"])
        plain = plain and {s.get("type") for s in normal} <= NORMALIZERS and all(s["pattern"].get("Regex") == r"\s+" and s["content"] == " " for s in normal if s.get("type") == "Replace")
        first = split[0]
        byte_level = first.get("type") == "ByteLevel" and first["use_regex"]
        spaceless = first.get("type") == "Split" and first["behavior"] == "Removed" and first["invert"] and " " not in first["pattern"].get("Regex", " ") and "\\S" not in first["pattern"].get("Regex", "")
        self.safe = plain and (byte_level or spaceless or first.get("type") in ("Whitespace", "WhitespaceSplit", "BertPreTokenizer"))
        self.words = self.safe and byte_level and not first["add_prefix_space"] and normal == [{}]

    def encode(self, texts: list[str]) -> list:
        return self.model.encode_batch_fast(texts, add_special_tokens=False)


def load(name: str, folder: str | None = None) -> Merges | Pieces:
    """The library's tokenizer for a file: sentencepiece for .model, tokenizers for .json."""
    if name.endswith(".model"):
        return Pieces(path(name, folder))
    if name.endswith(".json"):
        return Merges(path(name, folder))
    raise ValueError(f"no tokenizer for {name}")
