"""Words of texts, as a tokenizer file's normalizer and pre-tokenizer make them: a
fast path for texts of plain European letters under the one set-up below, the
library's own objects for all others."""
from __future__ import annotations

import json
import re
import unicodedata

# The set-up that the fast path stands for, as the file words it.
NORMALIZERS = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "},
               {"type": "Lowercase"}]
SPLIT = {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"},
         "behavior": "Removed", "invert": True}
#: Below this code point NFC changes nothing and all libraries agree on classes.
PLAIN_END = 0x180
NOT_PLAIN = "İ"      # lower-cases to two code points


def byte_symbols() -> list[str]:
    """The printable stand-in of every byte in byte-level vocabularies: bytes
    that print stand for themselves, the others follow from U+0100 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = [b for b in range(256) if b not in shown]
    return [chr(b) if b in shown else chr(256 + rest.index(b)) for b in range(256)]


class Splitter:
    """Cuts texts into units that are encoded one by one: plain words (str) and
    white-space chunks that only the library can cut (bytes)."""

    def __init__(self, library):
        said = json.loads(library.to_str())
        self.said = said
        self.special = {t["content"]: t["id"] for t in said["added_tokens"]}
        strings = sorted(self.special, key=len, reverse=True)
        self.special_at = re.compile("(" + "|".join(map(re.escape, strings)) + ")") if strings else None
        self.normal, self.split = library.normalizer, library.pre_tokenizer
        pre = (said.get("pre_tokenizer") or {}).get("pretokenizers") or [{}, {}]
        self.fast = ((said.get("normalizer") or {}).get("normalizers") == NORMALIZERS and pre[0] == SPLIT
                     and len(pre) == 2 and pre[1].get("type") == "ByteLevel"
                     and not pre[1].get("add_prefix_space") and not pre[1].get("use_regex"))
        chars = [chr(k) for k in range(PLAIN_END)]
        of = lambda kind: "".join(re.escape(c) for c in chars if unicodedata.category(c)[0] == kind)
        space = "\t\n\x0b\x0c\r \x85\xa0"
        self.plain = re.compile(rf"[^{NOT_PLAIN}ƀ-\U0010ffff]*").fullmatch
        self.find = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{of('L')}]+|[{of('N')}]|[^{space}{of('L')}{of('N')}]+").findall
        self.symbols = {b: s for b, s in enumerate(byte_symbols())}

    def units(self, text: bytes) -> list:
        """Normalizer and pre-tokenizer never act across ASCII white space."""
        said = text.decode("utf-8", "replace")
        if self._plain(said):
            return self.find(said.lower())
        out: list = []
        for chunk in text.split():
            part = chunk.decode("utf-8", "replace")
            if self._plain(part):
                out += self.find(part.lower())
            else:
                out.append(chunk)
        return out

    def _plain(self, text: str) -> bool:
        return bool(self.fast and self.plain(text)) and not (self.special_at and self.special_at.search(text))

    def words(self, unit) -> list:
        """Byte-level words and ids of special tokens of a unit, in order."""
        if unit.__class__ is str:
            if unit.isascii() and unit.isprintable():
                return [unit]
            return [unit.encode().decode("latin-1").translate(self.symbols)]
        text = unit.decode("utf-8", "replace")
        return [w for k, part in enumerate(self.special_at.split(text) if self.special_at else [text]) if part
                for w in ([self.special[part]] if k % 2 else self._cut(part))]

    def _cut(self, text: str) -> list:
        plain = self.normal.normalize_str(text) if self.normal else text
        return [w for w, _ in (self.split.pre_tokenize_str(plain) if self.split else [(plain, None)]) if w]
