"""Names of people and businesses as typed: tokens, how alike two tokens are, and the best alignment of two names."""

from __future__ import annotations

import functools
import re
import unicodedata

# Legal forms, titles, generation marks, and branch notes that follow a business name.
LEGAL = frozenset("INC INCORPORATED LLC LC LLP LP LTD LIMITED CO COMPANY COMPANI CORP CORPORATION PARTNERSHIP LIABILITY PC PLC THE OF AND A AN".split())
#: Words that say as little of what a business does.
GENERIC = frozenset("ENTERPRISE ENTERPRISES HOLDING HOLDINGS".split())
TITLES = frozenset("DR MR MS MRS MISS MD PHD ESQ DDS DVM RN CPA HON PROF REV".split())
GENERATIONS = frozenset("JR SR II III IV".split())
BRANCH = re.compile(
    r"(?:\b(?:ACCOUNTING|LEGAL|HR|IT|SALES) DEPT|\b(?:NORTH|SOUTH|EAST|WEST|MAIN) (?:CAMPUS|REGION|OFFICE|BRANCH)|\bFIELD OFFICE|\bMAIN OFFICE|\bHQ|\bHEADQUARTERS|\b(?:STORE|PLANT|UNIT|SUITE|BRANCH|DIVISION|DEPT) ?\d+)$"
)
#: Words of branch notes: they end no run of words.
BRANCH_WORDS = frozenset("FIELD MAIN PLANT STORE UNIT WEST EAST NORTH SOUTH REGION CAMPUS BRANCH DEPT DIVISION HEADQUARTERS SUITE OFFICE".split())
#: Short forms of given names, by the form they stand for.
SHORT_FORMS = """
ABIGAIL: ABBY ABBIE GAIL
ALEJANDRO: ALEX ALE
ALEXANDER: ALEX AL SANDY XANDER
ANDREW: ANDY DREW
ANTHONY: TONY
BARBARA: BARB BARBIE
BENJAMIN: BEN BENNY BENJI
CATHERINE: CATHY CATE CAT KATE KATIE
CHARLES: CHARLIE CHUCK CHAS
CHRISTINE: CHRIS TINA CHRISSY
CHRISTOPHER: CHRIS TOPHER KIT
CYNTHIA: CINDY
DANIEL: DAN DANNY
DAVID: DAVE DAVEY
DEBORAH: DEB DEBBIE DEBRA
DONALD: DON DONNIE
EDWARD: ED EDDIE TED NED
ELEANOR: ELLIE NELL NELLIE NORA
ELIZABETH: BETH LIZ BETTY BETSY LIZZIE ELIZA
EUGENE: GENE
FRANCISCO: PACO FRANK PANCHO CISCO
FREDERICK: FRED FREDDY FREDDIE
GERALD: JERRY GERRY
GREGORY: GREG
GUADALUPE: LUPE LUPITA
IGNACIO: NACHO
JACOB: JAKE
JAMES: JIM JIMMY JAMIE
JEFFREY: JEFF
JENNIFER: JEN JENNY
JONATHAN: JON JONNY
JORGE: GEORGE
JOSEPH: JOE JOEY
JOSEPHINE: JO JOSIE
JOSHUA: JOSH
KATHERINE: KATHY KATE KATIE KAT KIT
KENNETH: KEN KENNY
LAWRENCE: LARRY
LEONARD: LEN LENNY LEO
MADELINE: MADDIE MADDY
MARGARET: PEGGY MAGGIE MEG MARGE
MATTHEW: MATT
MICHAEL: MIKE MICK MICKEY
NICHOLAS: NICK NICKY
PAMELA: PAM
PATRICIA: PAT PATTY TRISH TRICIA
PATRICK: PAT PADDY
PENELOPE: PENNY
RAYMOND: RAY
REBECCA: BECKY BECCA
RICHARD: RICH RICK DICK RICKY
ROBERT: BOB BOBBY ROB ROBBIE BERT
RONALD: RON RONNIE
SAMANTHA: SAM SAMMIE
SAMUEL: SAM SAMMY
SANDRA: SANDY
STEPHEN: STEVE
STEVEN: STEVE
SUSAN: SUE SUZIE SUSIE
TERESA: TERRY TERI TESS
THEODORE: TED THEO TEDDY
THOMAS: TOM TOMMY
TIMOTHY: TIM TIMMY
VICTORIA: VICKY TORI VICKI
VINCENT: VINCE VINNY
VIRGINIA: GINNY
WALTER: WALT WALLY
WILLIAM: BILL BILLY WILL WILLIE LIAM
"""
ROOTS: dict[str, frozenset[str]] = {}
for _line in SHORT_FORMS.strip().splitlines():
    _root, _short = _line.split(":")
    for _name in [_root, *_short.split()]:
        ROOTS[_name] = ROOTS.get(_name, frozenset()) | {_root}

_CAMEL = re.compile(r"(?<=[a-z]{2})(?=[A-Z])")
#: Letters that are typed for one another.
SOUNDS = (("PH", "F"), ("QU", "KW"), ("CK", "K"), ("C", "K"), ("Z", "S"), ("Y", "I"), ("W", "V"))


def plain(text: str) -> str:
    """Upper case without accents, full stops and apostrophes."""
    decomposed = unicodedata.normalize("NFKD", text)
    bare = "".join(c for c in decomposed if not unicodedata.combining(c))
    return re.sub(r"[.'`‘’ʼ]", "", bare.upper())


@functools.lru_cache(maxsize=200_000)
def sounds(token: str) -> str:
    """The token with letters that are typed for one another made equal."""
    for a, b in SOUNDS:
        token = token.replace(a, b)
    return token


def edits(a: str, b: str, most: int) -> int:
    """Insertions, deletions, substitutions and swaps of neighbours from a to b; most + 1 if there are more."""
    if a == b:
        return 0
    if abs(len(a) - len(b)) > most:
        return most + 1
    two, one = None, list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            v = min(one[j] + 1, row[-1] + 1, one[j - 1] + (x != y))
            if two is not None and j > 1 and x == b[j - 2] and a[i - 2] == y:
                v = min(v, two[j - 2] + 1)
            row.append(v)
        if min(row) > most:
            return most + 1
        two, one = one, row
    return one[-1]


#: The rows of a keyboard; keys that touch are struck for one another.
KEYS = ("QWERTYUIOP", "ASDFGHJKL", "ZXCVBNM")
_AT = {c: (x + 0.5 * y, y) for y, row in enumerate(KEYS) for x, c in enumerate(row)}


def slip(a: str, b: str) -> bool:
    """b comes from a by one slip of the hand or ear: a letter left out, added, swapped, next to the right one, or sounding like it."""
    if a == b or sounds(a) == sounds(b):
        return True
    if edits(a, b, 1) > 1:
        return False
    if len(a) != len(b):
        return True
    wrong = [(x, y) for x, y in zip(a, b) if x != y]
    if len(wrong) == 2:
        return True
    (x, y) = wrong[0]
    if x not in _AT or y not in _AT:
        return False
    return abs(_AT[x][0] - _AT[y][0]) <= 1.01 and abs(_AT[x][1] - _AT[y][1]) <= 1


def abbreviates(short: str, word: str) -> bool:
    """short stands for word: the same first letter, its other letters in order in word, and clearly shorter."""
    if len(short) < 2 or len(short) >= len(word) or short[0] != word[0]:
        return False
    if word.startswith(short) and len(short) >= 2:
        return True
    if short[-1] == "S" and len(short) > 3 and word.startswith(short[:-1]):
        return True
    rest = iter(word[1:])
    return all(c in rest for c in short[1:]) and len(short) <= max(len(word) - 2, 2)


@functools.lru_cache(maxsize=500_000)
def likeness(a: str, b: str, person: bool) -> float:
    """How well token a stands for token b, from 0 to 1; the same both ways."""
    if a == b:
        return 1.0
    if len(a) > len(b):
        a, b = b, a
    if person:
        if len(a) == 1:
            return 0.75 if any(r[0] == a for r in ROOTS.get(b, frozenset()) | {b}) else 0.0
        if ROOTS.get(a, frozenset((a,))) & ROOTS.get(b, frozenset((b,))):
            return 0.92
    elif len(a) == 1:
        return 0.75 if len(b) > 4 and b[0] == a else 0.0
    elif abbreviates(a, b):
        return 0.9
    if sounds(a) == sounds(b):
        return 0.93
    if person and a in ROOTS and b in ROOTS and len(a) < 6:
        return 0.0  # two known given names
    if len(b) >= 4:
        d = edits(a, b, 2)
        if d == 1:
            return 0.9 if len(b) >= 5 else 0.8
        if d == 2 and len(a) >= 7:
            return 0.8
    return 0.0


def assignment(gain: list[list[float]]) -> list[int]:
    """The column of each row in the assignment of rows to different columns with the largest sum; no more rows than columns.

    Shortest augmenting paths with potentials: the work is rows squared times columns, at any length of names.
    """
    rows, columns = len(gain), len(gain[0])
    by_row, by_column, holder = [0.0] * (rows + 1), [0.0] * (columns + 1), [0] * (columns + 1)
    for row in range(1, rows + 1):
        holder[0], column = row, 0
        least, way, done = [float("inf")] * (columns + 1), [0] * (columns + 1), [False] * (columns + 1)
        while holder[column]:
            done[column] = True
            at, step, following = holder[column], float("inf"), 0
            for j in range(1, columns + 1):
                if not done[j]:
                    cost = -gain[at - 1][j - 1] - by_row[at] - by_column[j]
                    if cost < least[j]:
                        least[j], way[j] = cost, column
                    if least[j] < step:
                        step, following = least[j], j
            for j in range(columns + 1):
                if done[j]:
                    by_row[holder[j]] += step
                    by_column[j] -= step
                else:
                    least[j] -= step
            column = following
        while column:
            holder[column], column = holder[way[column]], way[column]
    out = [0] * rows
    for j in range(1, columns + 1):
        if holder[j]:
            out[holder[j] - 1] = j - 1
    return out


def align(a: tuple[str, ...], b: tuple[str, ...], person: bool) -> tuple[list[float], list[int], list[int]]:
    """The optimal assignment of tokens of a to tokens of b: (likeness of each pair, their places in a, and in b)."""
    if len(a) > len(b):
        s, ib, ia = align(b, a, person)
        return s, ia, ib
    if not a:
        return [], [], []
    gain = [[likeness(x, y, person) for y in b] for x in a]
    if all(gain[i][i] == 1.0 for i in range(len(a))):  # nothing is better than each with itself
        return [1.0] * len(a), list(range(len(a))), list(range(len(a)))
    pairs = [(gain[i][j], i, j) for i, j in enumerate(assignment(gain)) if gain[i][j] > 0]
    return [p[0] for p in pairs], [p[1] for p in pairs], [p[2] for p in pairs]


_RUN_LEGAL = re.compile(r"(?<=.{4})(?:INCORPORATED|CORPORATION|COMPANY|PARTNERSHIP)$")  # a long legal form run together with the word before


@functools.lru_cache(maxsize=200_000)
def legal_form(token: str) -> bool:
    """A legal form, or a long one with one letter wrong."""
    return token in LEGAL or len(token) >= 6 and any(len(w) >= 7 and edits(token, w, 1) <= 1 for w in LEGAL)


def business_tokens(name: str | None) -> tuple[str, ...]:
    """The tokens that tell one business from another: no legal form, no branch note."""
    if not name:
        return ()
    text = re.sub(r"[^A-Z0-9&]+", " ", plain(_CAMEL.sub(" ", name))).strip()
    text = re.sub(r"\b(NAT|INT) L\b", r"\1L", text)
    text = re.sub(r"\b(?:[A-Z] ){1,3}[A-Z]$", lambda m: m[0].replace(" ", ""), text)  # L L C
    for _ in range(2):
        text = BRANCH.sub("", text).strip()
    out = [_RUN_LEGAL.sub("", t) for t in text.split()]
    kept = tuple(t for t in out if not legal_form(t))
    return kept or tuple(out)


def person_tokens(name: str | None) -> tuple[tuple[str, ...], str, int]:
    """(the name's own tokens, its generation mark or '', how many of them stand before a comma; -1 without one)."""
    parts = [re.findall(r"[A-Z]+", part) for part in plain(name or "").split(",", 1)]
    tokens = [t for part in parts for t in part]
    marks = [t for t in tokens if t in GENERATIONS]
    own = lambda part: [t for t in part if t not in GENERATIONS and t not in TITLES]
    kept = tuple(own(tokens))
    first = len(own(parts[0]) if kept else parts[0])
    kept = kept or tuple(tokens)
    return kept, marks[0] if marks else "", first if len(parts) > 1 and 0 < first < len(kept) else -1


#: The score of two names of people of which one has but initials beside the family name: they are one only if no one else fits.
INITIALS = 0.6


def family_name(token: str, before: float | None) -> bool:
    """Whether a token is a family name: by the share of its names in which it stands before the comma, else no known given name."""
    return before >= 0.5 if before is not None else len(token) > 1 and token not in ROOTS


def same_person(a: tuple[str, ...], b: tuple[str, ...], a_family: tuple[bool, ...], b_family: tuple[bool, ...]) -> float:
    """The likeness of two people's names at one place with one generation mark; 0 if they can't be one person's.

    Every token of the shorter name must find its partner, a family name among them in full, and one more token. The longer
    name may have one more given name or initial, and one more half of a double family name. The frequency of a name plays no
    part. Names that agree in a family name and initials alone score INITIALS.
    """
    if not a or not b:
        return 0.0
    if len(a) > len(b):
        a, b, a_family, b_family = b, a, b_family, a_family
    scores, ia, ib = align(a, b, True)
    if len(scores) < len(a) or len(scores) < 2:
        return 0.0
    used = set(ib)
    left = [j for j in range(len(b)) if j not in used]
    halves = sum(len(b[j]) > 1 and b_family[j] for j in left)  # of a double family name
    if halves > 1 or len(left) - halves > 1:
        return 0.0
    family = any((w >= 0.8 and len(a[i]) > 3 or w == 1.0 and len(a[i]) > 1) and (a_family[i] or b_family[j]) for w, i, j in zip(scores, ia, ib))
    if not family and not all(w == 1.0 for w in scores):
        return 0.0
    full = [w for w, i, j in zip(scores, ia, ib) if len(a[i]) > 1 and len(b[j]) > 1]
    if len(full) < 2 and len(scores) < 3:
        # the name with the initials must have no other given name that could tell who it is
        open_ = any(len(b[j]) == 1 for j in ib) and any(len(b[j]) > 1 for j in left)
        return INITIALS if family and full == [1.0] and not open_ else 0.0
    return sum(scores) / len(scores) - 0.02 * len(left)


#: How many times as frequent one word must be than another to be told from it: a word from its misspelling, or from a head.
RARER = 20
#: How many times as frequent another word of a name must be than the one that names the business.
HEAD = 5


def same_business(a: tuple[str, ...], b: tuple[str, ...], a_counts: tuple[int, ...] | None = None, b_counts: tuple[int, ...] | None = None) -> float:
    """The likeness of two businesses' names at one place; 0 if they can't be one business's.

    a_counts and b_counts tell how many names hold each token (1 each, if not given): the rarest token of either name, which
    names the business, must have a full partner. Counts are compared with one another only, so other names do not matter.
    """
    if not a or not b:
        return 0.0
    if a == b:
        return 1.0
    a_counts, b_counts = a_counts or (1,) * len(a), b_counts or (1,) * len(b)
    if len(a) != len(b):
        x, y = "".join(sorted(a)), "".join(sorted(b))
        near = edits("".join(a), "".join(b), 2) <= 2 or abs(len(x) - len(y)) <= 1 and edits(x, y, 1) <= 1
        return 0.85 if near and len(x) > 8 else 0.0
    scores, ia, ib = align(a, b, False)
    def rarest(t: tuple[str, ...], counts: tuple[int, ...], but: int = -1) -> int:
        return min((k for k in range(len(t)) if k != but), key=lambda k: (len(t[k]) == 1, counts[k]))

    if len(scores) == len(a) - 1 and len(a) > 2 and scores.count(1.0) >= 2:  # one word each that is hardly the same
        i, j = next(i for i in range(len(a)) if i not in ia), next(j for j in range(len(b)) if j not in ib)
        low, high = sorted((a_counts[i], b_counts[j]))
        head_a, head_b = rarest(a, a_counts, i), rarest(b, b_counts, j)
        established = high < RARER * low and low >= RARER * min(a_counts[head_a], b_counts[head_b])  # two words, both in use
        if a[i][0] == b[j][0] and not established and (edits(a[i], b[j], 3) <= 3 or abs(len(a[i]) - len(b[j])) > 3):
            most = max(*a_counts, *b_counts)
            return 0.76 if any(w == 1.0 and (p == head_a or q == head_b) and HEAD * min(a_counts[p], b_counts[q]) <= most for w, p, q in zip(scores, ia, ib)) else 0.0
    if len(scores) < len(a):
        return 0.0
    rare_a, rare_b = rarest(a, a_counts), rarest(b, b_counts)
    if any(w < 0.8 for w, i, j in zip(scores, ia, ib) if i == rare_a or j == rare_b):
        return 0.0
    return sum(scores) / len(scores)
