"""Repair of text from scanned pages: running heads, page numbers, broken words and misread characters.

Noisy channel: what was printed is the sequence that maximises the probability of the confusions that turn it into what
was read times its n-gram likelihood in the corpus. Viterbi decoding runs over the candidate words of a line (word
bigrams), and for Chinese over the candidate characters (character trigrams). The probability of each confusion is
estimated from the scans themselves, by expected counts over the readings of each word and sign. Corpus counts are
exact: each chunk of scans asks for the n-grams of its candidates, and a join answers. Running heads are told from
headings by a corpus-wide statistic: heads stand inside sentences, headings don't.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.tables import materialise
from .textgrams import code_points, gram_hashes

#: Scans of a chunk on average; characters of corpus texts whose grams are counted together before the shuffle.
CHUNK, SLICE = 200, 2_000_000

# How scanning misreads signs, as read sign -> intended signs; several signs may stand for one.
LATIN = {
    "5": "s", "$": "s", "!": "i", "1": "li", "|": "li", "I": "l", "0": "oO", "@": "a", "†": "t", "c": "e", "u": "n", "n": "u", "6": "b", "8": "B", "9": "g", "q": "g", "f": "t", "h": "b", "b": "h", "e": "c",
    "o": "a", "a": "o", "v": "y", "t": "f", "l": "i", "i": "l", "3": "e", "(": "c", "€": "e", "¢": "c", "£": "f", "¡": "i", "+": "t", "rn": "m", "vv": "w", "cl": "d", "li": "h", "ii": "n", "ri": "n", "lc": "k", "tl": "d",
}
#: Signs read as one that were two.
MERGED = {"m": "rn", "w": "vv", "d": "cl", "h": "li", "n": "ri", "k": "lc"}
HAN = {
    "杌": "机", "曰": "日目", "枝": "技", "裴": "装", "抆": "投", "巿": "市", "屯": "电", "各": "备", "嚣": "器", "エ": "工", "亚": "业", "車": "单", "颔": "额", "拱": "供", "侧": "测", "严": "产", "顼": "项", "桧": "检", "没": "设", "仝": "企", "钉": "订",
    "末": "未", "己": "已", "干": "千", "土": "士", "人": "入", "入": "人", "大": "太", "囗": "口", "ロ": "口", "力": "力", "カ": "力", "ニ": "二", "ー": "一", "八": "人", "甲": "申", "由": "田", "拔": "拨", "扳": "板", "侍": "待", "侯": "候", "冶": "治", "洽": "治",
}
#: Share of a sign that is read as a given other one before any is seen, and how many signs that belief counts for.
SLIP, BELIEF = 2e-3, 100
#: Weight of word bigrams; smoothing of character trigrams and size of the character set it spreads over; signs of an unknown word.
BIGRAM, ALPHA, SIGNS, LETTERS = 0.7, 0.02, 3000, 30
#: Signs in a word that no word has; a word with more of them than MOST_ODD is a code.
ODD, MOST_ODD = "5$!1|0@†3689(€¢£¡+", 4
LOST = "□■▢▣●?�"
#: All confusions (read, intended), and what may have been printed.
PAIRS = [(r, t) for r, ts in LATIN.items() for t in (ts if len(r) == 1 else [ts])] + list(MERGED.items()) + [(r, t) for r, ts in HAN.items() for t in ts if t != r]
INTENDED = sorted({t for _, t in PAIRS})
HYPHENS = "-¬­‐‑"
NUMBER = re.compile(r"^\s*(?:[-–—·•~*]\s*\d{1,4}\s*[-–—·•~*]|[〔\[(（【]\s*\d{1,4}\s*[〕\])）】]|第\s*\d{1,4}\s*页(?:\s*[,，/]?\s*共\s*\d{1,4}\s*页)?|(?:page|p\.|pp\.)\s*\d{1,4}(?:\s*(?:of|/)\s*\d{1,4})?|\d{1,4}\s*/\s*\d{1,4}|\d{1,4})\s*$", re.I)
JOINED_NUMBER = re.compile(r"^(?:(\d{1,4})(?:\s*[|｜·]\s*|\s{2,}|\t)(.*\S)|(.*\S)(?:\s*[|｜·]\s*|\s{2,}|\t)(\d{1,4}))\s*$")
END = "。！？；：.!?;:”」"
# What stands in the frame of web pages only.
WEB = re.compile(r"©|cookie|版权所有|当前位置|您的位置|备案编号|友情链接|you are here|terms of use|all rights reserved|^home$|^首页$|分享到|点赞|^advertisement$|back to top|page views", re.I | re.M)
CJK = re.compile(r"[一-鿿]")
LETTER = re.compile(r"[a-z]")
ODD_INSIDE = re.compile(r"[a-z][@†!$|€¡£¢01][a-z]|^[@†!$|][a-z]{2,}|[a-z][†@$|]$")
TOKEN = re.compile(r"[^\s,;:.()（）\[\]“”\"'，。；：/|-]+(?:'[a-z]+)?")


def is_scan(lines: list[str]) -> bool:
    """Lines broken at one width, without what frames web pages."""
    return is_wrapped(lines) and not WEB.search("\n".join(lines[:8] + lines[-8:]))


def is_wrapped(lines: list[str]) -> bool:
    """Most lines are nearly as long as the longest, short, and end inside a sentence."""
    full = [x for x in (y.strip() for y in lines) if x and not NUMBER.match(x)]
    if len(full) < 4:
        return False
    lengths = np.sort([len(x) for x in full])
    wide = lengths[int(len(lengths) * 0.85)]
    if not 12 <= wide <= 115 or lengths[-1] > 1.35 * wide + 6:
        return False
    near = [x for x in full if len(x) >= 0.78 * wide]
    return len(near) >= 0.5 * len(full) and sum(x[-1] not in END for x in near) >= 0.5 * len(near)


def head_key(line: str) -> str:
    """A line without digits, spacing and case."""
    m = JOINED_NUMBER.match(line.strip())
    if m:
        line = m.group(2) or m.group(3)
    return re.sub(r"[\s\d|｜·]+", "", line).lower()


def kind_key(line: str) -> str:
    """What lines of a kind end with: the last four Chinese characters, or the last word."""
    key = head_key(line)
    if CJK.search(key):
        return "…" + key[-4:]
    m = JOINED_NUMBER.match(line.strip())
    words = ((m.group(2) or m.group(3)) if m else line).split()
    return "… " + words[-1].lower() if words else ""


def roles(lines: list[str]) -> list[str]:
    """blank, number, short (may be a head or heading) or body, for each line."""
    full = sorted(len(x.strip()) for x in lines if x.strip())
    wide = full[int(len(full) * 0.85)]
    out = []
    for x in lines:
        s = x.strip()
        if not s:
            out.append("blank")
        elif NUMBER.match(s):
            out.append("number")
        elif JOINED_NUMBER.match(s) and len(s) < 1.1 * wide:
            out.append("short")
        elif s[-1] in END or s[-1] in ",，、%" + HYPHENS or x.startswith("　　") or len(s) > 0.97 * wide:
            out.append("body")
        elif CJK.search(s):
            out.append("short" if len(s) < 0.9 * wide and not re.search(r"[，。；]", s) else "body")
        else:
            words = re.findall(r"[A-Za-z]+", s)
            out.append("short" if words and all(w[0].isupper() or w in ("of", "and", "the", "for", "in", "on") for w in words) and not re.search(r"[,;.]", s) and len(words) <= 9 and not re.search(r"\d,\d|\d\.\d", s) else "body")
    return out


def short_lines(lines: list[str]) -> list[dict]:
    """The short lines of a scan with their keys; evidence: the line parts a sentence or carries a page number."""
    role = roles(lines)
    count: dict[str, int] = {}
    for i, r in enumerate(role):
        if r == "short":
            count[head_key(lines[i])] = count.get(head_key(lines[i]), 0) + 1
    out, before = [], ""
    for i, r in enumerate(role):
        s = lines[i].strip()
        if r == "body":
            before = s
        elif r == "short":
            inside = bool(before) and before[-1] not in END
            near = any(role[j] == "number" for j in (i - 1, i + 1, i - 2 if i > 1 and role[i - 1] == "blank" else i, i + 2 if i + 2 < len(role) and role[i + 1] == "blank" else i) if 0 <= j < len(role) and j != i)
            sure = bool(JOINED_NUMBER.match(s)) or inside
            out.append({"no": i + 1, "key": head_key(s), "kind": kind_key(s), "sure": int(sure), "near": int(near or i == 0), "same": count[head_key(s)]})
    return out


def key_of(word: str) -> int:
    """What F.xxhash64 gives for a string."""
    import xxhash

    h = xxhash.xxh64_intdigest(word.encode("utf-8", "replace"), 42)
    return h - (1 << 64) if h >> 63 else h


def gram_key(s: str) -> int:
    return int(gram_hashes(np.array([ord(c) for c in s], dtype=np.uint32), len(s)).view(np.int64)[0])


class Source:
    """Exact corpus counts of words, word pairs and character grams that were asked for, and the confusions."""

    def __init__(self, counts: dict[int, int], words: int, confusions: dict[tuple[str, str], float]) -> None:
        self.counts, self.words, self.confusions = counts, max(words, 1), confusions
        self.keys: dict[str, int] = {}
        self.ways: dict[str, list] = {}
        self.options: dict[str, list] = {}

    def word(self, w: str) -> int:
        k = self.keys.get(w)
        if k is None:
            k = self.keys[w] = key_of(w)
        return self.counts.get(k, 0)

    def gram(self, s: str) -> int:
        k = self.keys.get("\n" + s)
        if k is None:
            k = self.keys["\n" + s] = gram_key(s)
        return self.counts.get(k, 0)

    def slip(self, read: str, intended: str) -> float:
        """Log probability that intended is read as read."""
        return math.log(self.confusions.get((read, intended), SLIP))

    def alone(self, w: str) -> float:
        """Log probability of a word; an unknown one is spelled sign by sign."""
        n = self.word(w) or self.word(w.lower())
        if n:
            return math.log(n / self.words)
        odd = sum(c in ODD for c in w)
        return math.log(0.01) - (len(w) - odd) * math.log(LETTERS) - odd * math.log(10 * LETTERS)

    def after(self, w: str, before: str | None) -> float:
        """Log probability of a word after another one."""
        p = (1 - BIGRAM) * math.exp(self.alone(w))
        n = self.word(before) if before else 0
        if n:
            p += BIGRAM * self.word(f"{before} {w}") / n
        return math.log(max(p, 1e-300))

    def third(self, s: str) -> float:
        """Log probability of the last of three characters after the others."""
        return math.log((self.gram(s) + ALPHA) / (self.gram(s[:2]) + ALPHA * SIGNS))


def slips(word: str) -> dict[str, list[tuple[str, str]]]:
    """The words that may have been printed where word is read, with the confusions each takes.

    All odd signs are put right, in each way there is, and one other sign or pair of signs at most.
    """
    places = [i for i, c in enumerate(word) if c in ODD and c in LATIN]
    if len(places) > MOST_ODD:
        return {}
    bases = [(word, [])]
    for i in reversed(places):
        bases += [(w[:i] + to + w[i + 1 :], [*took, (word[i], to)]) for w, took in bases for to in LATIN[word[i]]]
    out: dict[str, list[tuple[str, str]]] = {}
    for base, took in bases:
        if took:
            out.setdefault(base, took)
        if took and sum(c in ODD for c in base) or not took and len(places) > 1:
            continue
        for i in range(len(base)):
            for n in (1, 2):
                sign = base[i : i + n]
                if n == 1 and sign in ODD:
                    continue
                to_all = ([LATIN[sign]] if n == 2 and sign in LATIN else []) if n == 2 else [*LATIN.get(sign, ""), *([MERGED[sign]] if sign in MERGED else [])]
                for to in to_all:
                    out.setdefault(base[:i] + to + base[i + n :], [*took, (sign, to)])
    out.pop(word, None)
    return out


def known_slips(word: str, source: Source) -> list[tuple[str, list[tuple[str, str]]]]:
    """Those of slips that the corpus holds more than once."""
    if word not in source.ways:
        source.ways[word] = [x for x in slips(word).items() if source.word(x[0]) > 1]
    return source.ways[word]


def candidates(word: str, source: Source) -> list[tuple[str, float]]:
    """The word as read, and the words of the corpus it may stand for, with the log probability of the channel."""
    return [(word, 0.0)] + [(w, sum(source.slip(*x) for x in took)) for w, took in known_slips(word, source)]


def options(token: str, source: Source) -> list[tuple[str, float]]:
    """The candidates of a token of a line; a sign at its end may be punctuation."""
    got = source.options.get(token)
    if got is None:
        bare = token.rstrip("!?%")
        got = candidates(bare if source.word(bare) else token, source) if len(token) > 2 and is_word(token) else [(token, 0.0)]
        source.options[token] = got
    return got


def likeliest(word: str, source: Source) -> str:
    """The likeliest printed word, without context."""
    return max(candidates(word, source), key=lambda x: (source.alone(x[0]) + x[1], x[0] == word))[0]


def decode_words(line: list[list[tuple[str, float]]], source: Source) -> list[str]:
    """Viterbi path through the candidates (word, log channel probability) of the words of a line."""
    best: list[tuple[float, int]] = []
    back: list[list[int]] = []
    before: list[str | None] = [None]
    scores = [0.0]
    for options in line:
        step, at = [], []
        for w, channel in options:
            score, j = max((scores[j] + source.after(w, b), -j) for j, b in enumerate(before))
            step.append(score + channel)
            at.append(-j)
        back.append(at)
        before, scores = [w for w, _ in options], step
    if not line:
        return []
    j = max(range(len(scores)), key=lambda i: (scores[i], -i))
    path = []
    for options, at in zip(reversed(line), reversed(back), strict=True):
        path.append(options[j][0])
        j = at[j]
    return path[::-1]


def han_options(c: str) -> str:
    return c + HAN[c] if c in HAN and HAN[c] != c else c


def clusters(chars: str) -> list[tuple[int, int]]:
    """Ranges of a run that hold all signs with more than one option, with two signs on either side; between ranges nothing interacts."""
    out: list[list[int]] = []
    for i, c in enumerate(chars):
        if c in HAN and HAN[c] != c:
            if out and i - 2 <= out[-1][1]:
                out[-1][1] = min(len(chars), i + 3)
            else:
                out.append([max(0, i - 2), min(len(chars), i + 3)])
    return [(a, b) for a, b in out]


def han_grams(chars: str) -> set[str]:
    """The character pairs and triples that decoding a run looks at."""
    out: set[str] = set()
    for a, b in clusters(chars):
        for i in range(a, b - 2):
            for s in product(*(han_options(c) for c in chars[i : i + 3])):
                t = "".join(s)
                out.update((t, t[:2]))
    return out


def decode_han(chars: str, source: Source) -> dict[int, str]:
    """Changed places and intended characters of a run of text, by a Viterbi path over pairs of candidate characters."""
    changed = {}
    for a, b in clusters(chars):
        # state: the last two characters -> (score, path)
        states: dict[str, tuple[float, str]] = {"": (0.0, "")}
        for i in range(a, b):
            new: dict[str, tuple[float, str]] = {}
            for c in han_options(chars[i]):
                channel = 0.0 if c == chars[i] else source.slip(chars[i], c)
                for last, (score, path) in states.items():
                    total = score + channel + (source.third(last + c) if len(last) == 2 else 0.0)
                    key = (last + c)[-2:]
                    if key not in new or total > new[key][0]:
                        new[key] = (total, path + c)
            states = new
        path = max(states.values(), key=lambda x: x[0])[1]
        changed |= {a + k: c for k, c in enumerate(path) if c != chars[a + k]}
    # signs of which nothing is left stay, but are no good reading
    changed |= {i: c for i, c in enumerate(chars) if c in LOST and c != "?" and CJK.search(chars[max(0, i - 2) : i + 3])}
    return changed


def expected(tokens: list[str], run: str, source: Source) -> dict[tuple[str, str], float]:
    """Expected numbers of confusions among the words and signs of a page, by words and by the trigrams around a sign alone."""
    out: dict[tuple[str, str], float] = {}

    def share(options: list[tuple[float, list[tuple[str, str]]]]) -> None:
        top = max(x for x, _ in options)
        whole = sum(math.exp(x - top) for x, _ in options)
        for x, took in options:
            for pair in took:
                out[pair] = out.get(pair, 0.0) + math.exp(x - top) / whole

    for w in tokens:
        if len(options(w, source)) > 1 and not source.word(w) and not source.word(w.lower()):
            ways = [(w, []), *known_slips(w, source)]
            if len(ways) > 1:
                share([(source.alone(v) + sum(source.slip(*x) for x in took), took) for v, took in ways])
    for i, c in enumerate(run):
        if len(han_options(c)) > 1:
            around = lambda x, i=i: run[max(0, i - 2) : i] + x + run[i + 1 : i + 3]
            score = lambda s: sum(source.third(s[k : k + 3]) for k in range(len(s) - 2))
            share([(score(around(x)) + (0.0 if x == c else source.slip(c, x)), [] if x == c else [(c, x)]) for x in han_options(c)])
    return out


def body_of(lines: list[str], heads: set[int]) -> tuple[list[str], list[int]]:
    """The role of each line, and the places of the lines of body text."""
    role = roles(lines)
    return role, [i for i, r in enumerate(role) if i + 1 not in heads and r not in ("number", "blank")]


def is_word(w: str) -> bool:
    return len(w) > 1 and LETTER.search(w) is not None and not CJK.search(w)


def broken(s: str, t: str) -> tuple[str, str] | None:
    """The parts of a word that may be split over two lines."""
    if len(s) < 2 or s[-1] not in HYPHENS or not re.search(r"[A-Za-z0-9@†!|$]$", s[:-1]):
        return None
    first, rest = re.search(r"[^\s,;:.()“”\"'/]+$", s[:-1]), re.match(r"[^\s,;:.()“”\"'/-]+", t)
    if not first or not rest or not rest.group(0)[0].islower() and rest.group(0)[0] not in "5!10@†|$":
        return None
    return first.group(0).split("-")[-1], rest.group(0)


def stream(lines: list[str], body: list[int]) -> tuple[str, list[tuple[int, int]]]:
    """The Chinese body lines as one run, so that contexts reach over line ends, and where each sign stands."""
    parts, where = [], []
    for i in body:
        x = lines[i].strip("　 \t\r")
        if CJK.search(x):
            parts.append(x)
            where += [(i, k) for k in range(len(x))]
    return "".join(parts), where


def tokens_of(lines: list[str], body: list[int]) -> list[str]:
    return [w for i in body if LETTER.search(lines[i]) for w in TOKEN.findall(lines[i]) if is_word(w)]


def asked(lines: list[str], heads: set[int], words: set[str], done: set[str]) -> set[str]:
    """Adds the words whose counts the repair of a page looks at; gives the character grams. done: words read before."""
    _, body = body_of(lines, heads)

    def ask(w: str) -> None:
        if w not in done:
            done.add(w)
            words.update((w, w.lower(), *slips(w)))

    for w in set(tokens_of(lines, body)):
        ask(w)
        ask(w.rstrip("!?%"))
    for a, b in zip(body, body[1:], strict=False):
        parts = broken(lines[a].strip(" \t\r"), lines[b].strip(" \t\r"))
        if parts:
            words.update(parts)
            ask("".join(parts))
    return han_grams(stream(lines, body)[0])


def lattice(line: str, skip: tuple[bool, bool], source: Source) -> tuple[list[re.Match], list[list[tuple[str, float]]]]:
    """The tokens of a line with their candidates; parts of broken words at its ends (skip) stay as read."""
    if not LETTER.search(line):
        return [], []
    matches = list(TOKEN.finditer(line))
    ways = [options(m.group(0), source) for m in matches]
    for k, held in ((0, skip[0]), (-1, skip[1])):
        if held and ways:
            ways[k] = [(matches[k].group(0), 0.0)]
    return matches, ways


def repair(lines: list[str], heads: set[int], source: Source) -> tuple[list[tuple[int, str]], str]:
    """(line number, kind) of the lines to repair, and the text in continuous paragraphs."""
    role, body = body_of(lines, heads)
    found = [(i + 1, "running_head" if i + 1 in heads else "page_number") for i, r in enumerate(role) if i + 1 in heads or r == "number"]
    fixed = {i: lines[i].strip(" \t\r") for i in body}
    garbled: set[int] = set()
    joins: dict[int, bool] = {}
    # broken words: at a hyphen, the joined word against the compound
    split_word: dict[int, tuple[str, str]] = {}
    for a, b in zip(body, body[1:], strict=False):
        s, t = fixed[a].rstrip(), fixed[b].lstrip()
        cut = broken(s, t)
        if not cut:
            continue
        head, tail = cut
        whole = source.word(head + tail)
        parts = min(source.word(head), source.word(tail))
        meant = likeliest(head + tail, source)
        if s[-1] == "-":
            if not whole and parts:
                continue
            if whole <= parts / 50 and parts:
                continue
            if not whole and meant == head + tail:
                # neither is known: two words in the corpus make a compound
                if source.word(head) or source.word(tail):
                    continue
        joins[a] = True
        found.append((a + 1, "broken_word"))
        split_word[a] = (head, tail)
        if not whole and len(head + tail) > 3 and meant != head + tail:
            at = next((i for i, (x, y) in enumerate(zip(head + tail, meant, strict=False)) if x != y), len(meant))
            garbled.add(a if at < len(head) else b)
    cut_tail = {b for a, b in zip(body, body[1:], strict=False) if a in split_word}
    for i in body:
        s = fixed[i]
        matches, ways = lattice(s, (i in cut_tail, i in split_word), source)
        out, at = [], 0
        # where nothing is open there is one path
        path = decode_words(ways, source) if any(len(x) > 1 for x in ways) else [x[0][0] for x in ways]
        for k, (m, w) in enumerate(zip(matches, path, strict=True)):
            read = ways[k][0][0]
            odd = ODD_INSIDE.search(read) and is_word(read) and not source.word(read)
            if w != read or odd and not (i in cut_tail and k == 0 or i in split_word and k == len(matches) - 1):
                garbled.add(i)
            if w != read:
                out.append(s[at : m.start()] + w)
                at = m.start() + len(read)
        fixed[i] = "".join(out) + s[at:]
    text, where = stream(lines, body)
    new: dict[int, dict[int, str]] = {}
    for p, c in decode_han(text, source).items():
        i, k = where[p]
        garbled.add(i)
        new.setdefault(i, {})[k] = c
    for i, changes in new.items():
        chars = list(lines[i].strip("　 \t\r"))
        for k, c in changes.items():
            chars[k] = c
        fixed[i] = "".join(chars) if not lines[i].startswith("　　") else "　　" + "".join(chars)
    found += [(i + 1, "garbled") for i in garbled]
    pieces: list[str] = []
    for n, i in enumerate(body):
        s = fixed[i].rstrip()
        new_par = n == 0 or lines[i].startswith("　　") or role[i] == "short" or role[body[n - 1]] == "short"
        if new_par and pieces:
            pieces.append("\n")
        if joins.get(i):
            pieces.append(s[:-1].strip())
        elif s.endswith("-") or CJK.search(s[-1:]) or (s and s[-1] in "，。；、：%"):
            pieces.append(s.strip("　 "))
        else:
            pieces.append(s.strip("　 ") + " ")
    return sorted(found), "".join(pieces).strip()


def word_counts(texts: DataFrame) -> DataFrame:
    """(key, n): the words and pairs of adjacent words of a column of texts (text)."""
    words = texts.select(F.regexp_extract_all("text", F.lit(r"[A-Za-z]+(?:'[a-z]+)?"), F.lit(0)).alias("w"))
    pairs = F.when(F.size("w") > 1, F.transform(F.sequence(F.lit(1), F.size("w") - 1), lambda i: F.concat_ws(" ", F.get("w", i - 1), F.get("w", i))))
    terms = words.select(F.explode(F.concat("w", F.coalesce(pairs, F.array().cast("array<string>")))).alias("term"))
    return terms.groupBy("term").agg(F.count("*").alias("n")).select(F.xxhash64("term").alias("key"), "n", (~F.contains("term", F.lit(" "))).alias("single"))


def gram_counts(texts: DataFrame) -> DataFrame:
    """(key, n): the character pairs and triples with a Chinese character of a column of texts (text)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            ends = np.cumsum(pc.fill_null(pc.utf8_length(whole.column("text")), 0).to_numpy(zero_copy_only=False))
            at = 0
            while at < whole.num_rows:
                to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + SLICE, side="right")))
                points, _ = code_points(whole.slice(at, to - at).column("text"))
                han = (points >= 0x4E00) & (points <= 0x9FFF)
                for n in (2, 3):
                    h = gram_hashes(points, n).view(np.int64)
                    keep = np.zeros(len(h), dtype=bool)
                    for i in range(n):
                        keep |= han[i : i + len(h)]
                    key, times = np.unique(h[keep], return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(times)], ["key", "n"])
                at = to

    return texts.select("text").mapInArrow(count, "key bigint, n bigint").groupBy("key").agg(F.sum("n").alias("n"))


def _scans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    shape = pa.list_(pa.struct([("no", pa.int32()), ("key", pa.string()), ("kind", pa.string()), ("sure", pa.int32()), ("near", pa.int32()), ("same", pa.int32())]))
    for batch in batches:
        texts = batch.column("text").to_pylist()
        keep = [is_scan(t.split("\n")) for t in texts]
        shorts = [short_lines(t.split("\n")) for t, k in zip(texts, keep, strict=True) if k]
        kept = batch.filter(pa.array(keep, pa.bool_()))
        yield pa.RecordBatch.from_arrays([kept.column("id"), kept.column("text"), pa.array(shorts, shape)], ["id", "text", "shorts"])


def scanned(pages: DataFrame) -> DataFrame:
    """(id, text, heads array<int>): the scans among (id, text), with the line numbers of their running heads.

    Null and blank texts are no scans; a text that comes twice under one id counts once. A short line is a head if it parts a
    sentence or carries a page number; if a line like it in the page does; if its key does in most pages with it; or if
    lines of its kind do and it stands at a page's edge.
    """
    rows = pages.where(F.col("text").rlike(r"\S")).mapInArrow(
        _scans, "id bigint, text string, shorts array<struct<no:int,key:string,kind:string,sure:int,near:int,same:int>>"
    )
    rows = materialise(rows.dropDuplicates(["id"]), "scans")
    lines = rows.select("id", F.explode("shorts").alias("s")).select("id", "s.*")
    by_key = lines.groupBy("key").agg(F.avg("sure").alias("key_share"), F.count("*").alias("key_n"))
    by_kind = lines.groupBy("kind").agg(F.avg("sure").alias("kind_share"), F.count("*").alias("kind_n"))
    in_page = lines.groupBy("id", "key").agg(F.max("sure").alias("page_sure"))
    judged = lines.join(by_key, "key").join(by_kind, "kind").join(in_page, ["id", "key"])
    by_corpus = ((F.col("key_share") >= 0.25) & (F.col("key_n") >= 3)) | ((F.col("kind_share") >= 0.25) & (F.col("kind_n") >= 4))
    against = (F.col("kind_n") >= 20) & (F.col("kind_share") < 0.08) & (F.col("key_share") < 0.08)
    heads = judged.where(((F.col("page_sure") == 1) & ~against) | by_corpus).groupBy("id").agg(F.collect_set("no").alias("heads"))
    return rows.select("id", "text").join(heads, "id", "left")


def _by_page(t: pa.Table) -> Iterator[tuple[int, list[str], set[int]]]:
    for i, text, heads in zip(t["id"].to_pylist(), t["text"].to_pylist(), t["heads"].to_pylist(), strict=True):
        yield i, text.split("\n"), set(heads or ())


def _keys(chunk: int, keys: set[int]) -> pa.Table:
    return pa.table({"chunk": pa.array([chunk] * len(keys), pa.int32()), "key": pa.array(sorted(keys), pa.int64())})


def _source(own: pa.Table, words: int, confusions: dict[tuple[str, str], float]) -> Source:
    return Source(dict(zip(own["key"].to_pylist(), own["n"].to_pylist(), strict=True)), words, confusions)


def repaired(pages: DataFrame, corpus: DataFrame) -> DataFrame:
    """(id, found array<struct<line_no, kind>>, text) for each scan in pages (id, text); corpus: (text) the source model is counted on.

    Null corpus texts are ignored; without a corpus every word is unknown and only odd signs are found. What reaches the
    driver: the number of words of the corpus, and the expected counts of the confusions of the fixed tables above.
    """
    scans = scanned(pages)
    chunks = max(1, scans.count() // CHUNK)
    scans = materialise(scans.withColumn("chunk", F.pmod(F.xxhash64("id"), F.lit(chunks)).cast("int")), "chunks")
    by_chunk = scans.groupBy("chunk")
    words = materialise(word_counts(corpus.where("text is not null")), "words")
    total = words.where("single").agg(F.sum("n")).first()[0] or 0
    start: dict[tuple[str, str], float] = {}

    def ask(key: tuple, t: pa.Table) -> pa.Table:
        words, done, grams = set(), set(), set()
        for _, lines, heads in _by_page(t):
            grams |= asked(lines, heads, words, done)
        return _keys(key[0].as_py(), {key_of(w) for w in words} | {gram_key(g) for g in grams})

    first = by_chunk.applyInArrow(ask, "chunk int, key bigint")
    counts = words.select("key", "n").unionByName(gram_counts(corpus.where("text is not null")))
    known = materialise(first.join(counts, "key").groupBy("chunk", "key").agg(F.max("n").alias("n")), "known")

    def estimate(t: pa.Table, own: pa.Table) -> pa.Table:
        source, pairs, confusions, signs = _source(own, total, start), set(), {}, {}
        for _, lines, heads in _by_page(t):
            _, body = body_of(lines, heads)
            run = stream(lines, body)[0]
            tokens = tokens_of(lines, body)
            for pair, n in expected(tokens, run, source).items():
                confusions[pair] = confusions.get(pair, 0.0) + n
            whole = "\n".join([*tokens, run])
            for sign in INTENDED:
                signs[sign] = signs.get(sign, 0) + whole.count(sign)
            for i in body:
                _, ways = lattice(lines[i].strip(" \t\r"), (False, False), source)
                for a, b in zip(ways, ways[1:], strict=False):
                    # pairs of words that are not open are the same on all paths
                    if len(a) == 1 and len(b) == 1:
                        continue
                    pairs.update(key_of(f"{x} {y}") for x, _ in a if source.word(x) for y, _ in b if source.word(y))
        rows = [(None, None, a, b, n) for (a, b), n in confusions.items()] + [(None, None, None, s, float(n)) for s, n in signs.items() if n]
        asks = _keys(t["chunk"][0].as_py(), pairs)
        other = pa.table({c: pa.array([r[i] for r in rows], ty) for i, (c, ty) in enumerate(zip(("chunk", "key", "read", "intended", "n"), (pa.int32(), pa.int64(), pa.string(), pa.string(), pa.float64()), strict=True))})
        return pa.concat_tables([other, pa.table({"chunk": asks["chunk"], "key": asks["key"], "read": pa.nulls(len(pairs), pa.string()), "intended": pa.nulls(len(pairs), pa.string()), "n": pa.nulls(len(pairs), pa.float64())})])

    second = by_chunk.cogroup(known.groupBy("chunk")).applyInArrow(estimate, "chunk int, key bigint, read string, intended string, n double")
    second = materialise(second, "expected")
    seen = {(r["read"], r["intended"]): r["n"] for r in second.where("key is null").groupBy("read", "intended").agg(F.sum("n").alias("n")).collect()}
    confusions = {
        (read, to): (n + SLIP * BELIEF) / (seen.get((None, to), 0.0) + n + BELIEF) for read, to in PAIRS for n in [seen.get((read, to), 0.0)]
    }
    answers = second.where("key is not null").select("chunk", "key").join(words.select("key", "n"), "key").groupBy("chunk", "key").agg(F.max("n").alias("n"))

    def run(t: pa.Table, own: pa.Table) -> pa.Table:
        source = _source(own, total, confusions)
        got = [(i, *repair(lines, heads, source)) for i, lines, heads in _by_page(t)]
        shape = pa.list_(pa.struct([("line_no", pa.int64()), ("kind", pa.string())]))
        return pa.table({"id": pa.array([i for i, _, _ in got], pa.int64()), "found": pa.array([[{"line_no": n, "kind": k} for n, k in f] for _, f, _ in got], shape), "text": pa.array([x for _, _, x in got], pa.string())})

    both = known.unionByName(answers).groupBy("chunk")
    return by_chunk.cogroup(both).applyInArrow(run, "id bigint, found array<struct<line_no:bigint,kind:string>>, text string")
