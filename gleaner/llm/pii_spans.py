"""Personal-data patterns and candidate generators over one text (used inside
tasks). All offsets count code points, ends are exclusive."""

from __future__ import annotations

import re
import zlib
from bisect import bisect_left
from collections.abc import Iterator

KINDS = ("email", "ip", "card", "phone")
EMAIL, IP, CARD, PHONE = range(4)

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_CHAIN = re.compile(r"[0-9]+(?:\.[0-9]+)+")
_PART = re.compile(r"[0-9]+")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]+")


def luhn(digits: str) -> bool:
    total = 0
    for k, ch in enumerate(reversed(digits)):
        v = ord(ch) - 48
        if k % 2:
            v = v * 2 - 9 if v > 4 else v * 2
        total += v
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """As a leftmost search for a local part, ``@`` and a dotted domain, but
    from each ``@`` outwards, so that long words cost no second look."""
    at, last = text.find("@"), 0
    while at >= 0:
        start = at
        while start > last and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at) if start < at else None
        if found:
            last = found.end()
            yield start, last
        at = text.find("@", max(last, at + 1))


def _addresses(text: str) -> Iterator[tuple[int, int]]:
    """Four dotted numbers at a time, along each dotted chain of numbers."""
    for chain in _CHAIN.finditer(text):
        parts = [m.span() for m in _PART.finditer(text, chain.start(), chain.end())]
        for k in range(0, len(parts) - 3, 4):
            four = parts[k:k + 4]
            if all(len(v := text[a:b].lstrip("0")) < 3 or len(v) == 3 and int(v) <= 255 for a, b in four):
                yield four[0][0], four[3][1]


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the fixed patterns, sorted."""
    out = [(a, EMAIL, b) for a, b in _emails(text)] if "@" in text else []
    if _DIGIT.search(text):
        out += [(a, IP, b) for a, b in _addresses(text)]
        for m in _CARD.finditer(text):
            digits = _NOT_DIGIT.sub("", m.group())
            if 14 <= len(digits) <= 19 and luhn(digits):
                out.append((m.start(), CARD, m.end()))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 10 <= len(_NOT_DIGIT.sub("", m.group())) <= 15:
                    out.append((m.start(), PHONE, m.end()))
    return sorted(out)


# High-recall generators: looser than the patterns above and overlapping.
_LOOSE = (
    (EMAIL, re.compile(r"[A-Za-z0-9._%+-]{1,64} ?(?:@|\(at\)|\[at\]) ?[A-Za-z0-9-]{1,63}(?: ?(?:\.|\(dot\)|\[dot\]) ?[A-Za-z0-9-]{1,63}){1,8}")),
    (IP, re.compile(r"[0-9]{1,5}(?:[.:][0-9]{1,5}){3,4}")),
    (IP, re.compile(r"[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{0,4}){3,7}")),
    (CARD, re.compile(r"(?<![0-9])[0-9]{3,19}(?:[ ./-][0-9]{2,8}){0,6}")),
    (PHONE, re.compile(r"(?:(?:\+|00)[ ]?)?(?:\([0-9]{1,4}\)|[0-9]{1,4})(?:[ ./()-]{1,3}[0-9]{2,5}){1,5}")),
    (PHONE, re.compile(r"(?<![0-9])[0-9]{9,13}(?![0-9])")),
)
_HINTS = (
    re.compile(r"(?i)\b(?:e-?mail|mail|contact|write|courriel|correo)\b"),
    re.compile(r"(?i)\b(?:ip|host|server|address|addr)\b"),
    re.compile(r"(?i)\b(?:card|visa|credit|account|karte|carte|tarjeta)\b"),
    re.compile(r"(?i)\b(?:phone|tel|call|mobile|fax|telefon|telefono)\b"),
)
FEATURES = (
    "is_email", "is_ip", "is_card", "is_phone", "length", "digits", "letters", "separators", "groups", "longest_group", "separator_kinds",
    "luhn", "small_parts", "dots", "spaces", "joined_before", "joined_after", "digit_near", "quoted", "hint", "letter_share", "line_share",
)
CONTEXT = 24


def _features(text: str, kind: int, start: int, end: int) -> list[float]:
    own = text[start:end]
    before, after = text[max(0, start - CONTEXT):start], text[end:end + CONTEXT]
    digits = _NOT_DIGIT.sub("", own)
    groups = _PART.findall(own)
    letters = sum(c.isalpha() for c in own)
    seps = [c for c in own if not c.isalnum()]
    near = before + after
    return [
        *(float(kind == k) for k in range(4)), float(len(own)), float(len(digits)), float(letters), float(len(seps)), float(len(groups)),
        float(max(map(len, groups), default=0)), float(len(set(seps))), float(bool(digits) and luhn(digits[:64])),
        float(bool(groups) and all(len(g) < 4 and int(g) < 256 for g in groups)), float(own.count(".")), float(own.count(" ")),
        float(before[-1:].isalnum()), float(after[:1].isalnum()), float(sum(c.isdigit() for c in near)),
        float(bool(re.search(r"[=\"'#:/]\s?$", before))), float(bool(_HINTS[kind].search(before))),
        sum(c.isalpha() for c in near) / max(1, len(near)), near.count("\n") / max(1, len(near)),
    ]


def candidates(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int, int, bool, list[float]]]:
    """(kind, start, end, label, touches, features) of every proposed span;
    label: 1 if it is one of the fixed patterns' spans of its kind; touches:
    whether it overlaps any of those. The fixed spans are proposed too."""
    exact = {(k, a, b) for a, k, b in base}
    proposed = set(exact)
    digit, at = bool(_DIGIT.search(text)), "@" in text or "(at)" in text or "[at]" in text
    for kind, pattern in _LOOSE:
        if (at if kind == EMAIL else digit):
            proposed.update((kind, m.start(), m.end()) for m in pattern.finditer(text))
    out = []
    starts, furthest = [a for a, _k, _b in base], []
    for _a, _k, b in base:
        furthest.append(max(b, furthest[-1]) if furthest else b)
    for kind, a, b in sorted(proposed, key=lambda s: (s[1], s[2], s[0])):
        known = (kind, a, b) in exact
        if not known and kind in (CARD, PHONE) and len(_NOT_DIGIT.sub("", text[a:b])) < 7:
            continue
        earlier = bisect_left(starts, b)
        touches = earlier > 0 and furthest[earlier - 1] > a
        out.append((kind, a, b, int(known), touches, _features(text, kind, a, b)))
    return out


def _disguised(kind: int, own: str, style: int) -> str:
    """A span of a fixed pattern in a form that its pattern does not match."""
    if kind == EMAIL:
        name, domain = own.split("@", 1)
        at = (" (at) ", "(at)", " [at] ", " @ ")[style % 4]
        head, last = domain.rsplit(".", 1)
        return f"{name}{at}{head}{'.' if style // 4 % 2 else ' (dot) '}{last}"
    if kind == IP:
        return own.replace(".", ":")
    if kind == CARD:
        digits = _NOT_DIGIT.sub("", own)
        return (". "[style % 2].strip() or "/").join(digits[k:k + 4] for k in range(0, len(digits), 4))
    return own[1:] if style % 2 else "00" + own[1:]


def disguised_candidates(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int, list[float]]]:
    """(kind, start, end, features) of the fixed patterns' spans, each written
    in another form into its own surroundings, where the loose generators
    propose that form."""
    out = []
    for style, (a, kind, b) in enumerate(base, start=zlib.crc32(text.encode("utf-8", "replace"))):
        style = (style * 0x9E3779B1 >> 16) & 0xFF
        left = max(0, a - 4 * CONTEXT)
        new = _disguised(kind, text[a:b], style)
        around = text[left:a] + new + text[b:b + 4 * CONTEXT]
        span = (a - left, a - left + len(new))
        if any(m.start() <= span[0] and m.end() >= span[1] for k, pattern in _LOOSE if k == kind for m in pattern.finditer(around)):
            out.append((kind, a, b, _features(around, kind, *span)))
    return out
