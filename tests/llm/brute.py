"""Plain versions of the operators, for small inputs."""

import re
from collections import defaultdict
from html.parser import HTMLParser
from itertools import combinations

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def shingles(text, n):
    w = words(text)
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set()


class Union:
    """Union-find whose root is the smallest member."""

    def __init__(self):
        self.up = {}

    def root(self, x):
        while self.up.setdefault(x, x) != x:
            x = self.up[x]
        return x

    def link(self, a, b):
        a, b = sorted((self.root(a), self.root(b)))
        self.up[b] = a


def near_duplicates(docs, n, threshold=80):
    """{doc_id: (set size, component)} of (doc_id, text) pairs with distinct ids."""
    sets = {i: shingles(t, n) for i, t in docs}
    holders = defaultdict(list)
    for i, s in sets.items():
        for x in s:
            holders[x].append(i)
    common = defaultdict(int)
    for ids in holders.values():
        for a, b in combinations(ids, 2):
            common[a, b] += 1
    found = Union()
    for (a, b), k in common.items():
        if 100 * k >= threshold * (len(sets[a]) + len(sets[b]) - k):
            found.link(a, b)
    return {i: (len(s), found.root(i)) for i, s in sets.items()}


# Base patterns of personal data, as the contract gives them.
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
    return sum(d - 9 * (d > 9) for d in doubled) % 10 == 0


def personal_data(text):
    """(start, rank, stop, kind) of the base kinds."""
    out = []
    for rank, (kind, pattern) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, text or "", re.A):
            digits = re.sub("[^0-9]", "", m[0])
            good = {
                "email": lambda: True,
                "ip": lambda: all(int(x) <= 255 for x in m[0].split(".")),
                "card": lambda: 14 <= len(digits) <= 19 and luhn(digits),
                "phone": lambda: 10 <= len(digits) <= 15,
            }[kind]()
            if good:
                out.append((m.start(), rank, m.end(), kind))
    return sorted(out)


class Article(HTMLParser):
    """Blocks of a page's article elements, but for chrome, widgets and what class or id calls noise, by the library's parser."""

    LEFT_OUT = set("head nav aside footer form dialog menu script style noscript template textarea title svg iframe object select button math canvas".split())
    INLINE = set("a abbr b code em font i mark q s small span strong sub sup time u".split())
    EMPTY = set("area base br col embed hr img input link meta param source track wbr".split())
    NOISE = re.compile(r"(?:^|[\s_-])(?:ads?|adverts?|banner|promo|sponsor(?:ed)?|sidebar|menu|nav|comments?|cookies?|notice|newsletter|share|social|related|footer|header|popup)(?:$|[\s_-])", re.I)

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.open, self.blocks, self.text = [], [], ""

    def shown(self):
        names = [n for n, _ in self.open]
        if "article" not in names or any(out for _, out in self.open):
            return False
        inside = names[names.index("article") :]
        return "header" not in inside or any(re.fullmatch("h[1-6]", n) for n in inside)

    def flush(self):
        text = " ".join(self.text.split())
        if text:
            self.blocks.append(text)
        self.text = ""

    def handle_starttag(self, name, attributes):
        if name in self.EMPTY:
            self.text += " " if name == "br" else ""
            return
        hints = " ".join(v or "" for k, v in attributes if k in ("class", "id", "role", "aria-label"))
        out = name in self.LEFT_OUT or bool(self.NOISE.search(hints)) and name not in ("html", "body")
        if name not in self.INLINE or out:
            self.flush()
            if self.open and self.open[-1][0] == "p" and not out:
                self.open.pop()
        if name not in self.INLINE or out:
            self.open.append((name, out))

    def handle_endtag(self, name):
        if name in (n for n, _ in self.open):
            self.flush()
            while self.open.pop()[0] != name:
                pass

    def handle_data(self, data):
        if self.shown():
            self.text += data


def main_text(page):
    parser = Article()
    parser.feed(page or "")
    parser.close()
    parser.flush()
    return "\n\n".join(parser.blocks)
