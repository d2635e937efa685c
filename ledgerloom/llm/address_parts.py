"""Splitting a typed postal address into parts. Pure Python over one text; used on distinct texts only."""

from __future__ import annotations

import re
import unicodedata

#: Postal abbreviations.
STREET_TYPES = {
    "ave": ["ave", "av", "avenue", "aven"],
    "blvd": ["blvd", "boulevard", "boul", "bvd"],
    "cir": ["cir", "circle", "circ"],
    "ct": ["ct", "court", "crt"],
    "dr": ["dr", "drive", "drv"],
    "hwy": ["hwy", "highway", "hiway", "hwy"],
    "ln": ["ln", "lane"],
    "pkwy": ["pkwy", "parkway", "pky", "pkway"],
    "pl": ["pl", "place"],
    "rd": ["rd", "road"],
    "st": ["st", "street", "str"],
    "ter": ["ter", "terrace", "terr"],
    "way": ["way", "wy"],
    "sq": ["sq", "square"],
    "trl": ["trl", "trail"],
}
DIRECTIONS = {
    "n": ["n", "north", "no"], "s": ["s", "south", "so"], "e": ["e", "east"], "w": ["w", "west"],
    "ne": ["ne", "northeast"], "nw": ["nw", "northwest"], "se": ["se", "southeast"], "sw": ["sw", "southwest"],
}
ORDINALS = ["first", "second", "third", "fourth", "fifth", "sixth", "seventh", "eighth", "ninth", "tenth", "eleventh", "twelfth"]
STATES = {
    "al": "alabama", "ak": "alaska", "az": "arizona", "ar": "arkansas", "ca": "california", "co": "colorado",
    "ct": "connecticut", "de": "delaware", "dc": "district of columbia", "fl": "florida", "ga": "georgia",
    "hi": "hawaii", "id": "idaho", "il": "illinois", "in": "indiana", "ia": "iowa", "ks": "kansas", "ky": "kentucky",
    "la": "louisiana", "me": "maine", "md": "maryland", "ma": "massachusetts", "mi": "michigan", "mn": "minnesota",
    "ms": "mississippi", "mo": "missouri", "mt": "montana", "ne": "nebraska", "nv": "nevada", "nh": "new hampshire",
    "nj": "new jersey", "nm": "new mexico", "ny": "new york", "nc": "north carolina", "nd": "north dakota",
    "oh": "ohio", "ok": "oklahoma", "or": "oregon", "pa": "pennsylvania", "ri": "rhode island",
    "sc": "south carolina", "sd": "south dakota", "tn": "tennessee", "tx": "texas", "ut": "utah", "vt": "vermont",
    "va": "virginia", "wa": "washington", "wv": "west virginia", "wi": "wisconsin", "wy": "wyoming",
}
STATE_WORDS = {"penna": "pa", "penn": "pa", "calif": "ca", "fla": "fl", "del": "de", "virg": "va", "mary": "md"}
TOWN_WORDS = {
    "mls": "mills", "rdg": "ridge", "vlg": "village", "brg": "bridge", "lndg": "landing", "mdws": "meadows",
    "hbr": "harbor", "spg": "spring", "spgs": "springs", "hts": "heights", "vly": "valley", "pk": "park",
    "jct": "junction", "smt": "summit", "cor": "corner", "fls": "falls", "crk": "creek", "xing": "crossing",
    "gdns": "gardens", "shrs": "shores", "bch": "beach", "knl": "knoll", "holw": "hollow", "frg": "forge",
    "acrs": "acres", "wds": "woods", "nck": "neck", "blf": "bluff", "grn": "green", "cp": "camp", "chpl": "chapel",
}
UNIT_WORDS = {"apt", "apartment", "unit", "ste", "suite", "#", "rm", "room", "floor"}
NO_ADDRESS = {"", "unknown", "n/a", "na", "none", "null", "nan", "-", "not provided", "information requested"}

_TYPE = {w: k for k, ws in STREET_TYPES.items() for w in ws}
_DIR = {w: k for k, ws in DIRECTIONS.items() for w in ws}
_STATE = {v: k for k, v in STATES.items() if " " not in v} | STATE_WORDS
_ORD = {f"{i}{'st' if i == 1 else 'nd' if i == 2 else 'rd' if i == 3 else 'th'}": w for i, w in enumerate(ORDINALS, 1)}
_UNIT = re.compile(r"^[0-9]{1,4}[a-z]?$|^[a-z]$|^[a-z][0-9]{1,4}$")

PARTS = ["kind", "house", "dir", "street", "type", "unit", "town", "state", "zip"]


def parse(text: str) -> dict[str, str] | None:
    """The parts of an address, each ``""`` if absent; None if the text holds no location.

    A location has a house number or a box number. Long texts are read like short ones: one pass over their words.
    A street's name has any number of words. It ends at its type, or, without a type, at a comma or a wide gap; without
    either it is one word, and what follows is the town. Before a comma that the town follows, the last type counts
    ("1 Park Place Drive, Salem"); elsewhere the first does, as towns may end like streets ("1 Mill Road Upper Terrace").
    """
    t = unicodedata.normalize("NFKC", text).lower().strip()
    if t in NO_ADDRESS:
        return None
    t = re.sub(r"\b(\d{5})\s*-\s*(\d{4})\b", r"\1", t)
    t = re.sub(r"\bp\.?\s*o\.?\s*b(?:ox|\b)\.?|\bpost\s+office\s+box\b|\bpob\b|\bpo\s*bx\b", " box ", t)
    t = re.sub(r"#", " # ", t)
    t = re.sub(r"\b(apt|apartment|unit|ste|suite)(?=\d)", r"\1 ", t)
    t = re.sub(r"['’]", "", t)
    t = re.sub(r"\b([a-z])\.\s?([a-z])\.?(?![a-z])", lambda m: m[1] + m[2] if m[1] + m[2] in STATES else m[0], t)
    t = re.sub(r"\bwest\s+virginia\b", "wv", t)
    t = re.sub(r"\bnew\s+york\b", "ny", t)
    t = re.sub(r"\bdistrict\s+of\s+columbia\b", "dc", t)
    # (word, whether a comma or a wide gap stands before it)
    words: list[str] = []
    gaps: list[bool] = []
    apart = False
    for w in re.findall(r"#|[a-z]+|\d+[a-z]*(?:-[a-z0-9]+)?|[^\W\d_]+|,|\s{2,}", t):
        if w == "," or w.isspace():
            apart = True
            continue
        words.append(w)
        gaps.append(apart)
        apart = False
    p = dict.fromkeys(PARTS, "")
    p["kind"] = "street"
    # a unit: a unit word, or "no" before a number, with its id of one or two words
    out: list[tuple[str, bool]] = []
    i = 0
    apart = False
    while i < len(words):
        w = words[i]
        apart = apart or gaps[i]
        nxt = words[i + 1] if i + 1 < len(words) else ""
        is_unit = w in UNIT_WORDS or (w == "no" and nxt[:1].isdigit())
        if is_unit and nxt in ("#", "no"):
            i += 1
            nxt = words[i + 1] if i + 1 < len(words) else ""
        ident = nxt.replace("-", "")
        if is_unit and (_UNIT.match(ident)):
            i += 2
            if ident.isdigit() and i < len(words) and len(words[i]) == 1 and words[i].isalpha() and words[i] not in _DIR:
                ident += words[i]
                i += 1
            p["unit"] = p["unit"] or ident
            continue
        if w == "box" and nxt[:1].isdigit():
            p["kind"], p["house"] = "box", nxt.lstrip("0") or "0"
            i += 2
            out.append(("\0", apart))
            apart = False
            continue
        if w != "#":
            out.append((w, apart))
            apart = False
        i += 1
    # the zip: a number of five digits, or of three or four after a state (leading zeros lost)
    rest: list[tuple[str, bool]] = []
    numbers = sum(x.isdigit() for x, _ in out) + any(x == "\0" for x, _ in out)
    for k, (w, gap) in enumerate(out):
        before = out[k - 1][0] if k else ""
        known = before in STATES or before in _STATE
        if w.isdigit() and (len(w) == 5 or (known and numbers > 1 and len(w) in (3, 4) and k == len(out) - 1)) and not p["zip"]:
            p["zip"] = w.zfill(5)
        else:
            rest.append((w, gap))
    # the state: a code or name at the end, after the town, or before the zip
    first_type = next((k for k, (x, _) in enumerate(rest) if x in _TYPE), len(rest))
    for k in range(len(rest) - 1, -1, -1):
        w = rest[k][0]
        code = w if w in STATES else _STATE.get(w, "")
        if code and not (w in _TYPE and k > 0 and rest[k - 1][0].isalpha() and k < len(rest) - 1) and not (w in _TYPE and first_type >= k):
            p["state"] = code
            if k + 1 < len(rest):
                rest[k + 1] = (rest[k + 1][0], rest[k + 1][1] or rest[k][1])
            del rest[k]
            break
    if p["kind"] == "box":
        p["town"] = "".join(TOWN_WORDS.get(w, w) for w, _ in rest if w != "\0" and w.isalpha())
        return p
    at = next((k for k, (w, _) in enumerate(rest) if w.isdigit() and len(w) <= 6), None)
    if at is None:
        return None
    p["house"] = rest[at][0].lstrip("0") or "0"
    town, tail = [w for w, _ in rest[:at]], rest[at + 1 :]
    if len(tail) > 1 and tail[0][0] in _DIR and not (tail[1][0] in _TYPE and len(tail[0][0]) > 2):
        p["dir"] = _DIR[tail[0][0]]
        tail = tail[1:]
    after = [w for w, _ in tail]
    if after:
        # where a comma or wide gap ends the street: not before a type, which belongs to it
        end = next((k for k, (w, gap) in enumerate(tail) if k and gap and w not in _TYPE), len(tail))
        types = [k for k, w in enumerate(after) if k and w in _TYPE]
        inside = [k for k in types if k < end]
        if not town and len(after) == 3 and types == [2] and end == 3 and (p["zip"] or p["state"]):
            inside = []  # "12 Mill Upper Terrace MD": a town of two words, no street type
        if inside:
            stop = inside[-1] if end < len(tail) and inside[-1] == end - 1 else inside[0]
            street, p["type"], after = after[:stop], _TYPE[after[stop]], after[stop + 1 :]
        elif end < len(tail):
            street, after = after[:end], after[end:]
        else:
            street, after = after[:1], after[1:]
        p["street"] = "".join(_ORD.get(w, w) for w in street)
    p["town"] = "".join(TOWN_WORDS.get(w, w) for w in [*town, *after] if w.isalpha())
    return p
