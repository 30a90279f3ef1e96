"""Characters that look alike: fixed seed pairs of letters, and rules for the rest."""

from __future__ import annotations

import unicodedata

# Letters of other scripts that print like a Latin letter.
LATIN_LIKE = {
    "A": "АΑᎪ", "B": "ВΒᏴ", "C": "СϹᏟ", "D": "Ꭰ", "E": "ЕΕᎬ", "F": "Ϝ", "G": "ԌᏀ", "H": "НΗᎻ", "I": "ІΙӀ", "J": "ЈᎫͿ",
    "K": "КΚᏦK", "L": "Ꮮ", "M": "МΜᎷ", "N": "Ν", "O": "ОΟՕ", "P": "РΡᏢ", "Q": "Ԛ", "R": "Ꭱ", "S": "ЅՏᏚ", "T": "ТΤᎢ",
    "V": "ѴᏙ", "W": "ԜᎳ", "X": "ХΧ", "Y": "ҮΥᎩ", "Z": "ΖᏃ", "a": "аɑ", "c": "сϲ", "d": "ԁ", "e": "е", "g": "ɡ",
    "h": "һ", "i": "і", "j": "јϳ", "k": "κ", "l": "ӏ", "n": "ո", "o": "оοօ", "p": "рρ", "q": "ԛ", "s": "ѕ", "u": "ս",
    "v": "νѵ", "w": "ԝ", "x": "хχ", "y": "уү", "z": "ᴢ",
    "Ä": "Ӓ", "ä": "ӓ", "Ë": "Ё", "ë": "ё", "Ï": "Ї", "ï": "ї", "Ö": "Ӧ", "ö": "ӧ", "æ": "ӕ", "Æ": "Ӕ", "ə": "ә", "Ə": "Ә",
}
# Punctuation that prints alike. Curly and straight quotes differ visibly and are not here.
MARK_LIKE = {"-": "‐‑", "'": "ʹ", ";": ";", "·": "·•", "…": "", ":": "ː", "!": "ǃ", "Ω": "Ω", "Å": "Å", "µ": "μ"}
#: Kinds of compatibility decomposition that change width or joining, not what one reads.
SAME_LOOK = ("wide", "narrow", "noBreak", "initial", "medial", "final", "isolated")


def invisible(ch: str) -> bool:
    """Zero-width and formatting characters, variation selectors and fillers; joiners need their context."""
    return (unicodedata.category(ch) == "Cf" and not "\U000e0020" <= ch <= "\U000e007f" and ch not in "؀؁؂؃۝܏࣢") or "︀" <= ch <= "️" or ch in "͏ᅟᅠㅤ᠋᠌᠍឴឵"


def space(ch: str) -> bool:
    """Horizontal spaces of any width."""
    return unicodedata.category(ch) == "Zs" or ch == "\t"


def rule_equal(ch: str) -> str | None:
    """The string that ``ch`` prints like by rule, None if the rules say nothing."""
    if space(ch):
        return " " if ch != " " else None
    kind, _, parts = unicodedata.decomposition(ch).rpartition("> ")
    if not parts:
        return None
    text = "".join(chr(int(x, 16)) for x in parts.split())
    if not kind or kind[1:] in SAME_LOOK:
        return text
    ligature = "ﬀ" <= ch <= "ﬆ" or "Ĳ" <= ch <= "ĳ" or "Ǆ" <= ch <= "ǌ" or "Ǳ" <= ch <= "ǳ" or "Ⅰ" <= ch <= "ⅿ"
    return text if kind == "<compat" and ligature else None
