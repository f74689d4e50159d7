"""Secret scans: base patterns, and guess costs of values that stand in a credential context.

A value's guess cost is the least sum, over all ways to cut it into segments, of the log10 guesses of the segments:
words by rank (with a factor for capitals and for look-alike digits), dates, repeats of a unit of up to ``UNIT``
characters, keyboard walks and sequences, and brute force for single characters. The dynamic program weighs every start
and end of each of them; of walks and repeats, which have no greatest length, it keeps only the starts that can still win.
The words are a short fixed list of common passwords, then the words that most texts of the corpus hold as prose, at most
``DICTIONARY``: one Spark count over all texts, at least ``MIN_TEXTS`` texts each, words of equal counts all or none. A value of a
credential context whose cost reaches ``MIN_COST`` gives a span of kind ``guess``; a placeholder such as
``password = changeme123`` or an ordinary word (``password: required``) does not.

Texts are read whole in Arrow batches; the patterns run where a keyword occurs in the bytes. Defined results: null text
is empty and has no spans; repeated rows are scanned each; an empty table gives an empty result; other columns are
not read. A very long text is one row of an Arrow batch and is scanned whole.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortkit.llm import common
from cohortkit.llm.common import pieces

MIN_COST = 9.0
KINDS = ("assign", "access", "hex", "guess")
OUT = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_guess long, guess_cost double"
# The base patterns and their least lengths.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # maximal runs, so the same as all runs without the short ones
HEX_TABLE = bytes(ord("h") if chr(c) in "0123456789abcdef" else 32 for c in range(256))
MIN_VALUE, MIN_ACCESS = 6, 20
ASSIGN_KEYS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")
# More words that announce a credential, anywhere in a name (DB_PASS, aws_secret_access_key), but not in the ordinary words
# named here (author, secretary, compass). The rest of the name is taken at once, so that a text is read once.
ANNOUNCED = r"""(?:(?<!com)(?<!sur)(?<!tres)(?<!by)pass(?!ages?\b|engers?\b|ers?(?:by)?\b|i(?:on|ve|ng)|e[ds]\b|over|ports?\b|able)|pwd|credential
    |auth(?!or(?!i[sz]))|bearer|private_?key|access_?key|secret(?!ar(?:y|i)|i(?:on|ve)|ly)|token(?!i[sz])|api_?key)"""
CONTEXT = re.compile(ANNOUNCED + r"(?P<rest>[A-Za-z0-9_.-]*+)", re.I | re.A | re.X)
WHOLE = re.compile(ANNOUNCED + r"(?:word|wd|phrase|code|s)?[0-9_]*\Z", re.I | re.A | re.X)
# What leads from the name to the value; "is" and a blank alone (after bearer) are told apart by their groups.
LINK = re.compile(r"""["']?(?:\x20*[:=]\x20*|(?P<said>\x20+is\x20+))|(?P<blank>\x20+)""", re.I | re.A)
# A value that opens with a quote goes up to the same quote on its line (a backslash keeps the next character in the value);
# any other value, or one without that quote, ends at a blank, a quote or a bracket.
QUOTED = re.compile(r'''"(?P<value>(?:\\[^\r\n]|[^"\\\r\n])*+)"'''), re.compile(r"""'(?P<value>(?:\\[^\r\n]|[^'\\\r\n])*+)'""")
BARE = re.compile(r"""["']?(?P<value>[^\s"'<>()\[\]{},;]+)""")
PLAIN_WORD = re.compile(r"[A-Za-z][a-z]{0,18}[.!?:]*")
CONTEXT_KEYS = (b"pass", b"pwd", b"credential", b"auth", b"bearer", b"private_key", b"privatekey", b"access_key", b"accesskey", *ASSIGN_KEYS[2:])
# Common words of passwords, most common first.
WORDS = """password admin welcome login qwerty letmein monkey dragon master hello secret test user root pass guest love
sunshine princess football baseball iloveyou shadow michael superman batman trustno ninja access flower hottie freedom
whatever changeme default example sample dummy fake temp temporary demo token value string your here none null true false
key api apikey placeholder insert replace redacted hidden unknown change server system manager database oracle mysql postgres
service account public private config prod production staging local summer winter spring autumn monday friday january
june july august october december company office computer internet network security""".split()
RANK = {w: math.log10(i + 2) for i, w in enumerate(WORDS)}
LONGEST = max(map(len, WORDS))
LOOKALIKE = str.maketrans("013457@$", "oleastas")
ROWS = ("1234567890", "qwertyuiop", "asdfghjkl", "zxcvbnm", "abcdefghijklmnopqrstuvwxyz")
NEXT = {a + b for row in ROWS for a, b in (*zip(row, row[1:]), *zip(row[::-1], row[::-1][1:]))}
MONTH, DAY, YEAR = "(?:0[1-9]|1[0-2])", r"(?:0[1-9]|[12]\d|3[01])", r"(?:19|20)\d\d"
DATES = [(re.compile(YEAR), 2.1), (re.compile(f"{YEAR}[-/.]?{MONTH}[-/.]?{DAY}"), 4.6), (re.compile(f"{DAY}[-/.]{MONTH}[-/.]{YEAR}"), 4.6)]
DIGIT, LETTER, OTHER, JOINT = 1.0, math.log10(26), math.log10(33), 0.6
UNIT = 8  # longest repeated unit
DICTIONARY, MIN_TEXTS, EVEN = 30_000, 3, 1_024  # most corpus words in the dictionary; the least number of texts that hold one
# A word of prose: lower-case letters alone, not the value of a name, so that a secret which many copies hold is no word.
PROSE = r"""(?<![\w:=/+.@$-]|[:=]["']|[:=]\x20["']?)[a-z]{4,19}(?![\w:=/+@$-])"""
SEGMENT = 0.3  # log10 of the ways to join one more segment


class Starts:
    """Starts of a run's segments, of which the best for the current end is asked; a segment costs cost[start] + log10(length).

    Of two starts the cheaper and earlier one overtakes the later one at most once and for good, and one that is neither
    cheaper nor later than another never wins again. So only starts of rising cost and falling total are kept.
    """

    def __init__(self) -> None:
        self.kept: list[tuple[int, float]] = []

    def add(self, start: int, cost: float) -> None:
        while self.kept and self.kept[-1][1] >= cost:
            self.kept.pop()
        self.kept.append((start, cost))

    def best(self, end: int) -> float:
        least, left = math.inf, []
        for start, cost in self.kept:
            total = cost + math.log10(end - start)
            if total < least:
                least = total
                left.append((start, cost))
        self.kept = left
        return least


def guess_cost(value: str, rank: dict[str, float] = RANK, longest: int = LONGEST) -> float:
    """log10 of the guesses that the cheapest of all segmentations needs; ``rank``: log10 guesses of a word of at most ``longest``."""
    n, low = len(value), value.lower()
    low = low if len(low) == n else value
    plain = low.translate(LOOKALIKE)
    cost = [0.0] + [math.inf] * n
    dates: dict[int, list[tuple[int, float]]] = {}
    for i in range(n):
        if value[i].isdigit():
            for pattern, guesses in DATES:
                if m := pattern.match(value, i):
                    dates.setdefault(m.end(), []).append((i, guesses))
    walk, steps = Starts(), 0
    # for each length of the repeated unit: characters in a row that equal the one a unit before, and starts by their remainder
    same, units = [0] * (UNIT + 1), [[Starts() for _ in range(u)] for u in range(UNIT + 1)]
    for j in range(1, n + 1):
        ch = value[j - 1]
        least = cost[j - 1] + (DIGIT if ch.isdigit() else LETTER + 0.3 * ch.isupper() if ch.isalpha() else JOINT if ch in "_-." else OTHER)
        for i in range(j - 3, max(0, j - longest) - 1, -1):
            guesses = rank.get(plain[i:j])
            if guesses is not None:
                least = min(least, cost[i] + guesses + SEGMENT + 0.3 * (value[i:j] != low[i:j]) + 0.5 * (low[i:j] != plain[i:j]))
        for i, guesses in dates.get(j, ()):
            least = min(least, cost[i] + SEGMENT + guesses)
        if j > 1 and low[j - 2: j] in NEXT:
            steps += 1
            if steps >= 2:
                walk.add(j - 3, cost[j - 3])
                least = min(least, SEGMENT + 1.5 + walk.best(j))
        elif steps:
            walk, steps = Starts(), 0
        for unit in range(1, min(UNIT, j - 1) + 1):
            if ch == value[j - 1 - unit]:
                same[unit] += 1
                if same[unit] >= unit:
                    starts = units[unit][j % unit]
                    starts.add(j - 2 * unit, cost[j - 2 * unit])
                    least = min(least, SEGMENT + unit * LETTER - math.log10(unit) + starts.best(j))
            elif same[unit]:
                if same[unit] >= unit:
                    units[unit] = [Starts() for _ in range(unit)]
                same[unit] = 0
        cost[j] = least
    return cost[n]


def values(text: str) -> Iterator[tuple[int, int]]:
    """(start, end) of the values in a credential context. A name inside a value counts if its own value starts after that."""
    end = 0
    for m in CONTEXT.finditer(text):
        link = LINK.match(text, m.end())
        if not link or link.end() < end or (link["said"] and not WHOLE.search(m[0])):
            continue
        if link["blank"] and not m[0].lower().endswith("bearer"):
            continue
        value = next((v for q in (*QUOTED, BARE) if (v := q.match(text, link.end()))), None)
        if not value or not value["value"]:
            continue
        # after "bearer" and a blank an ordinary word is no token, unless the name of a header or a variable goes before
        if link["blank"] and PLAIN_WORD.fullmatch(value["value"]) and not any(c in ":=" for c in text[max(0, m.start() - 3): m.start()]):
            continue
        end = value.end("value")
        yield value.span("value")


def spans(raw: bytes, rank: dict[str, float] = RANK, longest: int = LONGEST) -> tuple[list[tuple[str, int, int]], float | None]:
    """Spans (kind, start, end in code points) of a UTF-8 text, and the greatest cost of a value in a credential context."""
    low = raw.lower()
    assign, context = any(k in low for k in ASSIGN_KEYS), any(k in low for k in CONTEXT_KEYS)
    access = b"AKIA" in raw
    digits = raw.translate(HEX_TABLE)
    hexed = b"h" * 24 in digits
    if not (assign or context or access or hexed):
        return [], None
    text, out, most = raw.decode("utf-8", "replace"), [], None
    if assign:
        out += [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= MIN_VALUE]
    if access:
        out += [("access", *m.span()) for m in ACCESS.finditer(text) if len(m[0]) >= MIN_ACCESS]
    if hexed:
        out += [("hex", *m.span()) for m in HEX.finditer(text)]
    if context:
        for a, b in values(text):
            cost = guess_cost(text[a:b], rank, longest)
            most = cost if most is None else max(most, cost)
            if cost >= MIN_COST:
                out.append(("guess", a, b))
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0]))), most


def _row(raw: bytes, rank: dict[str, float], longest: int) -> tuple:
    found, most = spans(raw, rank, longest)
    said = lambda x: ",".join(f"{k}:{s}:{e}" for k, s, e in x)
    base = [s for s in found if s[0] != "guess"]
    n = {k: sum(s[0] == k for s in found) for k in KINDS}
    return n["assign"], n["access"], n["hex"], hashlib.sha256(said(base).encode()).hexdigest(), said(found), n["guess"], most


def corpus_words(texts: DataFrame, words: int = DICTIONARY) -> dict[str, float]:
    """log10 guesses of the fixed common words and, after them, of the words that most texts (column text) hold as prose.

    Whole levels of equal counts (in steps of 1% from ``EVEN`` texts on) are taken from the top while at most ``words``
    words come together, so no more than these ever leave the tasks.
    """
    found = texts.select(F.explode(F.array_distinct(F.regexp_extract_all(F.col("text"), F.lit(PROSE), F.lit(0)))).alias("word"))
    n = F.col("n")
    level = F.when(n < EVEN, n).otherwise(EVEN + F.floor(F.log(n / EVEN) / math.log(1.01)))
    counted = common.stored(found.groupBy("word").agg(F.count("*").alias("n")).filter(n >= MIN_TEXTS).withColumn("level", level), "secret-words")
    least, taken = None, 0
    for r in counted.groupBy("level").agg(F.count("*").alias("n")).orderBy(F.desc("level")).collect():  # a few thousand levels
        taken += r["n"]
        if taken > words:
            break
        least = r["level"]
    rank = dict(RANK)
    if least is not None:
        for r in counted.filter(F.col("level") >= least).orderBy(F.desc("n"), "word").select("word").collect():
            rank.setdefault(r["word"], math.log10(len(rank) + 2))
    return rank


def scan(docs: DataFrame, rank: dict[str, float] | None = None) -> DataFrame:
    """``OUT`` for every document; ``rank``: the dictionary, ``corpus_words`` of all texts if it is not given."""
    rank = corpus_words(docs) if rank is None else rank
    longest = max(map(len, rank), default=0)
    shared = docs.sparkSession.sparkContext.broadcast(rank)  # bounded by ``DICTIONARY``
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.float64())
    names = [c.split()[0] for c in OUT.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = shared.value
        for b in pieces(batches):
            rows = [_row(t, words, longest) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), *[pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)]], names)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), common.utf8(F.col("text")).alias("t")).mapInArrow(run, OUT)
