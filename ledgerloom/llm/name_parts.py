"""Splitting typed names of people and organizations. Pure Python over one text; used on distinct texts only."""

from __future__ import annotations

import re
import unicodedata

#: Usual short forms of given names.
NICKNAMES = {
    "abigail": "abby gail abbie", "alexander": "alex al xander sandy", "alexandra": "alex sandra lexi sasha",
    "andrew": "andy drew", "angela": "angie", "anthony": "tony", "barbara": "barb barbie babs", "benjamin": "ben benny benji",
    "charles": "charlie chuck chas charley", "christine": "chris tina chrissy", "christopher": "chris kit topher",
    "cynthia": "cindy", "daniel": "dan danny", "deborah": "deb debbie debby", "dennis": "denny den",
    "dorothy": "dot dottie dolly dottie", "edward": "ed eddie ted ned", "elizabeth": "liz beth betty lizzie eliza betsy",
    "eugene": "gene", "florence": "flo florrie", "frederick": "fred freddie freddy", "gabrielle": "gabby gabi",
    "gerald": "jerry gerry", "gregory": "greg", "harold": "harry hal", "jacqueline": "jackie", "james": "jim jimmy jamie",
    "jeffrey": "jeff", "jessica": "jess jessie", "jonathan": "jon jonny", "joseph": "joe joey", "joshua": "josh",
    "judith": "judy", "katherine": "kate kathy katie kathie", "kathleen": "kathy kate kath", "kenneth": "ken kenny",
    "lawrence": "larry", "leonard": "len lenny leo", "margaret": "meg maggie peggy marge margie", "matthew": "matt",
    "michael": "mike mick mickey", "nicholas": "nick nicky", "nikolai": "nick niko", "pamela": "pam", "patricia": "pat patty tricia trish patti",
    "patrick": "pat paddy", "percival": "percy", "peter": "pete", "raymond": "ray", "rebecca": "becky becca", "richard": "rick dick rich ricky",
    "robert": "bob bobby rob robbie", "roger": "rog", "ronald": "ron ronnie", "samantha": "sam sammie", "samuel": "sam sammy",
    "stephanie": "steph", "stephen": "steve", "steven": "steve", "susan": "sue susie", "sylvia": "syl", "theodore": "ted teddy theo",
    "theresa": "terry tess tessa", "thomas": "tom tommy", "timothy": "tim timmy", "victoria": "vicky vicki tori", "virginia": "ginny ginger",
    "walter": "walt wally", "william": "bill billy will willie liam", "zachary": "zach zack", "donald": "don donnie", "david": "dave davey",
    "philip": "phil", "jennifer": "jen jenny", "nathaniel": "nate nat", "nancy": "nan", "catherine": "cathy kate", "craig": "",
}
TITLES = {"mr", "mrs", "ms", "miss", "dr", "mx", "hon", "rev", "prof", "sen", "rep", "del", "esq", "md", "phd"}
SUFFIXES = {"jr": "jr", "sr": "sr", "ii": "2", "iii": "3", "iv": "4", "v": "5", "2nd": "2", "3rd": "3", "junior": "jr", "senior": "sr"}
PARTICLES = {"mc", "mac", "o", "de", "st", "van", "von", "la", "le", "di", "del", "der", "den", "al", "el"}
#: Words of organizations' names, abbreviations first.
ORG_WORDS = {
    "engrg": "engineering", "eng": "engineering", "mfg": "manufacturing", "rlty": "realty", "dev": "development",
    "comm": "community", "coll": "college", "med": "medical", "grp": "group", "dept": "department", "hlth": "health",
    "constr": "construction", "const": "construction", "plbg": "plumbing", "svcs": "services", "svc": "services", "assoc": "associates",
    "assocs": "associates", "consltg": "consulting", "mgmt": "management", "transp": "transportation", "tech": "technologies",
    "univ": "university", "ins": "insurance", "agcy": "agency", "hosp": "hospital", "intl": "international", "ctr": "center",
    "assn": "association", "cmte": "committee", "cttee": "committee", "natl": "national",
}
LEGAL = {
    "inc", "incorporated", "llc", "lc", "lp", "llp", "ltd", "limited", "co", "company", "corp", "corporation", "pc",
    "partners", "ptnrs", "sons", "and", "the", "of", "plc", "pllc", "partner",
}
INDUSTRY = {
    "engineering", "manufacturing", "realty", "development", "community", "college", "medical", "group", "department",
    "health", "construction", "plumbing", "services", "associates", "consulting", "management", "transportation",
    "technologies", "university", "insurance", "agency", "hospital", "international", "law", "center", "association",
    "committee", "national", "school", "schools", "county", "public", "bank", "foods", "store", "stores", "small", "donor", "conduit",
    "pac", "action", "political", "fund", "union", "local",
}
#: What people write who name no employer.
NO_EMPLOYER = {
    "", "retired", "none", "na", "n a", "self", "self employed", "selfemployed", "info requested per best efforts",
    "information requested", "info requested", "not provided", "not employed", "notemployed", "unemployed", "homemaker", "nan",
    "unknown", "null", "requested", "student", "disabled", "retd", "information requested per best efforts", "not applicable",
    "best efforts", "refused", "home maker", "house wife", "housewife", "no employer", "not available", "in between jobs",
}

_MISTYPED_THE = {"the", "teh", "hte", "th", "te", "he", "thhe", "tthe", "thee", "tne", "tle"}
_FORMAL: dict[str, list[str]] = {}
for _formal, _short in NICKNAMES.items():
    for _s in _short.split():
        _FORMAL.setdefault(_s, []).append(_formal)


def formal_names(token: str) -> list[str]:
    """The given names a token may stand for, itself included."""
    return [token, *[f for f in _FORMAL.get(token, []) if f != token]]


def plain(text: str) -> str:
    t = unicodedata.normalize("NFKD", text)
    return "".join(c for c in t if not unicodedata.combining(c)).lower()


def person(text: str) -> dict[str, object]:
    """tokens in their order, quoted nickname, generation and whether the family name is known to come first.

    Particles are joined to the word after them ("O'Brien", "Mc Donald" and "De Lane" are one token each).
    """
    t = plain(text)
    head = re.match(r"\s*([a-z'’\-]+)\s\s+[a-z]", t)
    nick = ""
    m = re.search(r"[\"“(']\s*([a-z]{2,})\s*[\"”)']", t)
    if m and not re.search(r"\b[a-z]'", m.group(0)[:2]):
        nick = m.group(1)
        t = t.replace(m.group(0), " ")
    comma = t.find(",")
    known = "comma" if comma >= 0 else "wide" if head and not re.match(r"\s*(mr|mrs|ms|dr|miss)\.?\s", t) else ""
    words = [w for w in re.split(r"[^a-z0-9\-]+", re.sub(r"['’`]", " ' ", t).replace(" ' ", "'").replace("'", "")) if w.strip("-")]
    family_words = len([w for w in re.split(r"[^a-z0-9\-]+", re.sub(r"['’`]", "", t[:comma])) if w.strip("-")]) if comma >= 0 else 0
    suffix = ""
    tokens: list[str] = []
    glue = ""
    cut_at = -1
    for k, w in enumerate(words):
        w = w.strip("-")
        if comma >= 0 and k == family_words:
            cut_at = len(tokens)
        if w in TITLES and (len(words) > 2):
            continue
        if w in SUFFIXES and k > 0 and not (w == "v" and k < len(words) - 1) and not (w == "v" and known == "comma"):
            suffix = suffix or SUFFIXES[w]
            continue
        if w in PARTICLES and k < len(words) - 1 and len(words[k + 1]) > 1 and (len(w) > 1):
            glue += w
            continue
        tokens.append(glue + w)
        glue = ""
    if glue:
        tokens.append(glue)
    if known == "comma" and cut_at < 0:
        cut_at = len(tokens)
    if known == "comma" and (cut_at == 0 or cut_at == len(tokens)):
        known = ""  # the comma only set off a title or generation
    return {"tokens": tokens, "nick": nick, "suffix": suffix, "order": known, "family": max(cut_at, 0) if known == "comma" else 0}


def organization(text: str) -> dict[str, str]:
    """core: the words that tell an organization apart, run together; line: the sorted words of its trade."""
    t = re.sub(r"['’`.]", "", plain(text).replace("&", " and ").replace("+", " and "))
    words = [ORG_WORDS.get(w, w) for w in re.findall(r"[a-z0-9]+", t)]
    if len(words) > 2 and words[0] in _MISTYPED_THE:
        words = words[1:]
    plain_words = [w for w in words if w not in LEGAL]
    core = [w for w in plain_words if w not in INDUSTRY]
    line = [w for w in plain_words if w in INDUSTRY]
    if not core:
        core, line = plain_words or words, []
    return {"core": "".join(core), "line": " ".join(sorted(set(line)))}


def names_employer(text: str | None) -> bool:
    """Whether a text names an employer at all."""
    if text is None:
        return False
    t = " ".join(re.findall(r"[a-z0-9]+", plain(text)))
    return t not in NO_EMPLOYER


def looks_like_organization(text: str) -> bool:
    words = [ORG_WORDS.get(w, w) for w in re.findall(r"[a-z0-9]+", re.sub(r"['’`.]", "", plain(text)))]
    return any(w in INDUSTRY or (w in LEGAL and w not in {"and", "of", "the", "co", "pc", "lp", "lc"}) for w in words)


#: Short forms of occupations.
JOBS = {
    "carp": "carpenter", "driver": "truck driver", "pharm": "pharmacist", "elec": "electrician", "dir of sales": "sales director",
    "sales dir": "sales director", "chief exec": "chief executive officer", "ceo": "chief executive officer", "financial adv": "financial advisor",
    "fin advisor": "financial advisor", "pm": "project manager", "proj mgr": "project manager", "police ofcr": "police officer",
    "officer": "police officer", "rn": "registered nurse", "nurse": "registered nurse", "re broker": "real estate broker",
    "broker": "real estate broker", "admin asst": "administrative assistant", "admin assistant": "administrative assistant",
    "sw engineer": "software engineer", "software eng": "software engineer", "vp": "vice president", "v p": "vice president",
    "lawyer": "attorney", "atty": "attorney", "attorney at law": "attorney", "teacher": "school teacher", "tchr": "school teacher",
    "prof": "professor", "acct": "accountant", "md": "physician", "m d": "physician", "doctor": "physician", "retd": "retired", "r n": "registered nurse",
    "c e o": "chief executive officer", "p m": "project manager",
}
NO_JOB = {"", "n a", "none", "na", "nan", "not provided", "unknown", "information requested", "info requested per best efforts"}


def job(text: str | None) -> str:
    """The occupation a text names, short forms written out; empty if it names none."""
    t = " ".join(re.findall(r"[a-z0-9]+", plain(text or "")))
    return "" if t in NO_JOB else JOBS.get(t, t)
