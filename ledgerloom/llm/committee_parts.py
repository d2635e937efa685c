"""Reading a committee's name: kind, style, person or core words. Pure Python over one text; distinct texts only."""

from __future__ import annotations

import re

from ledgerloom.llm.name_parts import PARTICLES, SUFFIXES, TITLES, formal_names, plain

#: Abbreviations of words in committee names.
SHORT = {
    "citz": "citizens", "citizen": "citizens", "frnds": "friends", "friend": "friends", "frnd": "friends", "cmte": "committee",
    "cttee": "committee", "comm": "committee", "com": "committee", "comte": "committee", "campn": "campaign", "cmpgn": "campaign",
    "4": "for", "ctrl": "central", "cent": "central", "cntrl": "central", "assn": "association", "assoc": "association", "gop": "republican",
    "dem": "democratic", "rep": "republican", "polit": "political", "pol": "political", "cnty": "county", "ppl": "people",
}
STYLES = ["citizens", "friends", "people", "team", "committee", "campaign"]
PARTIES = {"green", "democratic", "republican", "libertarian", "independent"}
OFFICES = {
    "school": "education", "education": "education", "delegate": "delegates", "delegates": "delegates", "senate": "senator",
    "senator": "senator", "sheriff": "sheriff", "mayor": "mayor", "judge": "judge", "governor": "governor", "register": "wills",
    "wills": "wills", "comptroller": "comptroller", "clerk": "clerk", "attorney": "attorney", "states": "attorney", "council": "council",
    "executive": "executive", "commissioner": "commissioner",
}
FIELDS = ["kind", "style", "last", "first", "firsts", "mid", "suffix", "core", "office"]


def _near(word: str, target: str) -> bool:
    if word == target:
        return True
    if len(target) < 4 or abs(len(word) - len(target)) > 1 or len(word) < 3:
        return False
    if sorted(word) == sorted(target):
        return True
    a, b = (word, target) if len(word) <= len(target) else (target, word)
    i = 0
    while i < len(a) and a[i] == b[i]:
        i += 1
    return a[i + (len(a) == len(b)) :] == b[i + 1 :]


def office_of(text: str | None) -> str:
    words = re.findall(r"[a-z]+", plain(text or "").replace("'", ""))
    if "city" in words and "comptroller" in words:
        return "citycomptroller"
    if "city" in words and "council" in words:
        return "citycouncil"
    return next((OFFICES[w] for w in words if w in OFFICES), "")


def parse(text: str) -> dict[str, object]:
    t = plain(text)
    t = re.sub(r"-?\s*\bstate account\b|\(md\)|\"", " ", t)
    words = re.findall(r"[a-z0-9\-]+", re.sub(r"['’`.]", "", t))
    words = [SHORT.get(w, w) for w in words if w.strip("-")]
    fixed = []
    for w in words:
        hit = next((s for s in (*STYLES, "central", "county", "slate", "elect", "political", "action", "question", "residents") if len(w) > 3 and _near(w, s)), w)
        fixed.append(hit)
    if len(fixed) > 1 and len(fixed[-1]) > 1:  # a field's end may have cut the last word
        fixed[-1] = next((x for x in ("committee", "campaign", "action", "political") if x.startswith(fixed[-1])), fixed[-1])
    words = [w for w in fixed if w not in {"the", "inc", "incorporated"}]
    while words and words[-1] in {"md", "llc"}:
        words.pop()
    out: dict[str, object] = dict.fromkeys(FIELDS, "")
    out["firsts"] = []
    s = set(words)
    if "slate" in s:
        out["kind"] = "slate"
    elif "pac" in s or ("political" in s and "action" in s) or "local" in s or "political" in s:
        out["kind"] = "pac"
    elif "question" in s:
        out["kind"] = "ballot"
    elif "central" in s or ("county" in s and s & PARTIES):
        out["kind"] = "party"
    else:
        out["kind"] = "candidate"
    if out["kind"] != "candidate":
        drop = {"committee", "pac", "political", "action", "slate", "of", "central", "county", "co", "for", "on", "vote", "question", "residents", "team"}
        core = [w for w in words if w not in drop]
        out["style"] = " ".join(sorted(w for w in s if w in {"state", "team", "vote", "residents"}))
        if out["kind"] == "party":
            core = [w for w in core if w != "state"]
        out["core"] = " ".join(sorted(core))
        return out
    trailing = False
    n = len(words)
    person: list[str] = words
    if n > 1 and words[0] == "committee":
        out["style"] = "committee"
        person = [w for w in words[1:] if w not in {"to", "elect"}]
    elif n > 1 and words[0] in {"citizens", "friends", "people", "team"}:
        out["style"] = words[0]
        person = [w for w in words[1:] if w not in {"for", "of"}]
    else:
        at = next((k for k, w in enumerate(words) if w in {"citizens", "friends", "people", "team", "committee", "campaign"} and k), None)
        if at is not None:
            out["style"] = words[at]
            person, trailing = words[:at], words[at] != "campaign"
        elif "for" in words[1:]:
            at = words.index("for", 1)
            out["style"], person = "office", words[:at]
            out["office"] = office_of(" ".join(words[at:]))
    tokens: list[str] = []
    glue = ""
    for k, w in enumerate(person):
        if w in TITLES:
            continue
        if w in SUFFIXES and k > 0 and w != "v":
            out["suffix"] = SUFFIXES[w]
            continue
        if w in PARTICLES and len(w) > 1 and k < len(person) - 1 and len(person[k + 1]) > 1:
            glue += w
            continue
        tokens.append(glue + w)
        glue = ""
    if tokens:
        if trailing:
            out["last"], given = tokens[0], tokens[1:]
        else:
            out["last"], given = tokens[-1], tokens[:-1]
        if given:
            out["first"] = given[0]
            out["firsts"] = formal_names(given[0])
            out["mid"] = given[1] if len(given) > 1 else ""
    out["core"] = " ".join(sorted(tokens))
    return out
