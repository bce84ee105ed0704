"""Personal data: wide generators propose spans, boosted trees choose among them.

Base spans (email, ip, card, phone) follow fixed rules and always stay.  Beyond them, generators of
high recall propose overlapping candidates: loose numbers, spelled-out addresses, long mixed
tokens, values after a key.  Boosted trees score each candidate by its format and by what stands
around it; scores are calibrated on candidates kept out of training, and the threshold is the one of
the best F measure there.  Of overlapping candidates the likeliest stays,
and none that overlaps a base span.

No table has labels for spans, so training labels come from two places.  Rules that are rarely wrong
label candidates of the corpus: base spans and well-known key formats are positive; candidates that
fail a checksum or a range, and ordinary words next to candidates, are negative.  And spans are
planted in made-up sentences, in the formats of `POSITIVE` and `NEGATIVE`: spelled addresses, national
phone numbers, cards with other separators and keys against dates, file names, commit hashes,
numbers of orders and the like; a planted span's candidates with other edges are negative.  The trees
are fitted on at most `sample` candidates of the corpus, those with the smallest hashes, and on the
planted ones, so the sample is bounded and the same in every run.  Each kind has its own threshold,
measured on candidates kept out of training that are no base spans.

* Null or empty texts have no spans; rows that repeat give a row each.
* A table without candidates (an empty one, for instance) is judged by the planted spans alone.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from brisa.llm import boost
from brisa.llm.common import slices, smallest, stored, texts

KINDS = ("email", "ip", "card", "phone", "secret")
SAMPLE, BETA, EACH, FOLDS = 6_000, 1.0, 40, 6
TREES = {"trees": 100, "depth": 4, "rate": 0.3, "ridge": 1.0, "share_seen": 0.3}

_LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
_LOCAL_RUN = re.compile(r"[A-Za-z0-9._%+-]*\Z")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A match never begins inside a run of digits, so starts there need not be tried.
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGITS = re.compile(r"[0-9]+")
_LETTERS = re.compile(r"[A-Za-z]+")

_NUMBER = re.compile(r"(?<![\w.])\+?\(?[0-9](?:[0-9]|[ ().\-/]{1,2}(?=[0-9(]))+(?!\w)")
_TOKEN = re.compile(r"(?<![\w+/-])[\w+/-]{16,}(?:={1,2}(?![\w=]))?")
_VALUE = re.compile(r"(?<!\w)\w{2,20}\s?[=:]\s?[\"']?([^\s\"']{5,}[^\s\"'.,;:])")
_SPELLED = re.compile(
    r"(?<![\w.+-])[\w.+-]{1,64}\s?(?:@|\(at\)|\[at\]|\bat\b)\s?[\w-]{1,64}(?:(?:\.|\s?(?:\(dot\)|\[dot\]|\bdot\b)\s?)[\w-]{1,64})+",
    re.IGNORECASE,
)
_AT = re.compile(r"@|\bat\b", re.IGNORECASE)  # what a spelled address cannot do without
_WORD = re.compile(r"[^\s]+")
_KEY = re.compile(r"(?:pass|passw\w*|pwd|secret|token|key|auth)\W{0,4}\Z", re.IGNORECASE)
_CONTACT = re.compile(r"(?:tel|phone|call|fax|mail|contact|card)\W{0,4}\Z", re.IGNORECASE)
_OTHER = re.compile(
    r"(?:commit|sha-?[0-9]*|md5|hash|digest|checksum|rev\w*|build|order|invoice|isbn|id|date|version|size|fixed in|see)\W{0,4}\Z",
    re.IGNORECASE,
)
_DATE = re.compile(r"(?<![0-9])(?:19|20)[0-9]{2}(?:[-/._]?(?:0[1-9]|1[0-2])(?:[-/._]?(?:0[1-9]|[12][0-9]|3[01]))?)?(?![0-9])")
_PREFIXES = ("AKIA", "AIza", "eyJ", "ghp_", "gho_", "sk-", "xox")
_SURE = re.compile(r"AKIA[A-Z0-9]{16}\Z")
_HEX = re.compile(r"[0-9a-f]+\Z|[0-9A-F]+\Z")


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if k % 2 == 0 else (2 * d if d < 5 else 2 * d - 9)
    return total % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """From each @ the run before it is taken back to its start, so long runs are read once."""
    out, done = [], 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > done and _LOCAL.match(text[start - 1]):
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            out.append((start, domain.end()))
            done = domain.end()
        else:
            done = max(done, at + 1)
        at = text.find("@", max(at + 1, done))
    return out


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """The fixed rules: leftmost and not overlapping within a kind, failing matches dropped."""
    out = [("email", a, b) for a, b in emails(text)]
    if _DIGITS.search(text):
        for m in _IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
                out.append(("ip", m.start(), m.end()))
        for m in _CARD.finditer(text):
            digits = m[0].replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and luhn(digits):
                out.append(("card", m.start(), m.end()))
        for m in _PHONE.finditer(text):
            if 9 <= sum(map(len, _DIGITS.findall(m[0]))) <= 15:
                out.append(("phone", m.start(), m.end()))
    return in_order(out)


def in_order(spans: Iterable[tuple]) -> list[tuple]:
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def candidates(text: str) -> list[tuple[str, int, int]]:
    """What the wide generators propose; spans may overlap and may repeat base spans."""
    found = set()
    for m in _NUMBER.finditer(text):
        n = sum(c.isdigit() for c in m[0])
        if 7 <= n <= 12 and m[0].count(".") == 3 and m[0].replace(".", "").isdigit():
            found.add(("ip", m.start(), m.end()))
        elif 7 <= n <= 15:
            found.add(("phone", m.start(), m.end()))
        if 12 <= n <= 19:
            found.add(("card", m.start(), m.end()))
    for m in _TOKEN.finditer(text):
        # digits alone are a number's business
        if any(c.isalpha() for c in m[0]) and (any(c.isdigit() for c in m[0]) or m[0].isupper()):
            found.add(("secret", m.start(), m.end()))
    if "=" in text or ":" in text:
        for m in _VALUE.finditer(text):
            if any(c.isdigit() for c in m[1]):
                found.add(("secret", m.start(1), m.end(1)))
    if _AT.search(text):
        found.update(("email", m.start(), m.end()) for m in _SPELLED.finditer(text))
    return in_order(found)


def features(text: str, kind: str, start: int, end: int) -> list[float]:
    s, left, right = text[start:end], text[max(0, start - 24) : start], text[end : end + 2]
    digits = [c for c in s if c.isdigit()]
    alpha = [c for c in s if c.isalpha()]
    runs = _DIGITS.findall(s)
    parts = s.split(".")
    low = s.lower()
    return [
        len(s),
        len(digits),
        len(alpha),
        sum(c.isupper() for c in alpha),
        s.count(" "),
        s.count("."),
        s.count("-"),
        s.count("(") + s.count(")"),
        len(s) - len(digits) - len(alpha),
        len(set(s)) / len(s),
        len(runs),
        max(map(len, runs), default=0),
        sum(c in "aeiouAEIOU" for c in alpha) / max(1, len(alpha)),
        bool(_HEX.match(s)),
        12 <= len(digits) <= 19 and luhn("".join(d for d in digits if d.isascii())),
        len(parts) == 4 and all(p.isascii() and p.isdigit() and len(p) < 4 and int(p) < 256 for p in parts),
        s.startswith("+"),
        s.startswith("("),
        "@" in s,
        " at " in low,
        "(at)" in low or "[at]" in low,
        " dot " in low or "(dot)" in low or "[dot]" in low,
        s.count("_"),
        s.count("/"),
        runs[0].startswith("0") if runs else False,
        len(runs[0]) if runs else 0,
        len(runs[-1]) if runs else 0,
        max(map(len, _LETTERS.findall(s)), default=0),
        sum(a.isdigit() != b.isdigit() or a.isupper() != b.isupper() for a, b in pairwise(s)) / len(s),
        bool(_DATE.search(s)),
        sum(c.islower() for c in alpha) / max(1, len(alpha)),
        bool(_OTHER.search(left)),
        s.startswith(_PREFIXES),
        left[-1:] in ("=", ":"),
        left[-1:] in ('"', "'") and right[:1] == left[-1:],
        bool(_KEY.search(left)),
        bool(_CONTACT.search(left)),
        left[-1:].isalnum(),
        right[:1].isalnum(),
        *(kind == k for k in KINDS),
    ]


def labelled(text: str) -> list[tuple[str, int, int, int]]:
    """Candidates whose label a rule is sure of: (kind, start, end, 1 or 0)."""
    base = set(base_spans(text))
    out = []
    for kind, a, b in {*candidates(text), *base}:
        s = text[a:b]
        n = sum(c.isdigit() for c in s)
        if (kind, a, b) in base or (kind == "secret" and (_SURE.match(s) or (_KEY.search(text[max(0, a - 24) : a]) and n >= 4 and sum(c.isalpha() for c in s) >= 2))):
            out.append((kind, a, b, 1))
        elif kind == "ip" or (kind == "card" and not luhn("".join(c for c in s if c in "0123456789"))):
            out.append((kind, a, b, 0))
        else:
            continue
        # whole words near it, none that touches the span or the edge of what is looked at
        near = [*_WORD.finditer(text, max(0, a - 60), a), None, *_WORD.finditer(text, b, min(len(text), b + 60))]
        cut = near.index(None)
        near = near[1 : max(1, cut - 1)] + near[cut + 2 : -1]
        out += [("secret", m.start(), m.end(), 0) for m in near if m[0].isalpha()]
    return out


#: What is planted for training.  In braces: w a word, W one in capitals, a letter and a count for
#: digits (d), hex digits (x), letters and digits (b), capitals (U), capitals and digits (u), digits of
#: a valid card by fours (k), a year (y), month (m) and day (t).  After | what stands before the span.
POSITIVE = {
    "email": (
        "{w} (at) {w} (dot) com", "{w}.{w} [at] {w} [dot] org", "{w} at {w} dot net", "{w}{d2}(at){w}.com", "{w}[at]{w}.{w}.org",
        "{w}_{w} (at) {w}-{w} (dot) {w} (dot) org", "{w} AT {w} DOT com", "{w}.{w}{d2} at {w} dot com", "{w}[at]{w}[dot]com",
        "{w} @ {w}.com|mail ",
    ),
    "phone": (
        "({d3}) {d3} {d3} {d3}", "({d3}) {d3}-{d4}", "({d4}) {d6}", "({d2}) {d4}-{d4}", "({d4}) {d3} {d3}", "0{d2} {d4} {d4}", "0{d1} {d2} {d2} {d2} {d2}", "0{d3}/{d7}",
        "{d3}-{d3}-{d4}", "{d3}.{d3}.{d4}", "0{d3}-{d6}", "00{d2} {d3} {d4} {d3}", "{d3} {d3} {d4}|call ", "0{d9}|tel: ",
        "{d10}|phone: ", "0{d4} {d6}|fax ",
    ),
    "card": ("{k.}", "{k/}", "{k.}|card: "),
    "secret": (
        "{b24}|token=", "{x40}|token = \"", "{x32}|api_key=", "{w}{d2}{w}{d2}|password=", "{w}{d1}x{d2}|pwd=", "{x18}|password=",
        "{w}{d3}!|password: ", "{w}_{w}{d3}|auth_key: ", "{w}-{w}{d2}|secret: ", "{x8}-{x4}-{x4}-{x4}-{x12}|api_key=", "{u5}-{u5}-{u5}|key: ",
        "{b20}|SECRET_KEY: ", "{U20}|KEY: ", "{b40}|secret: ", "{b32}|auth=", "{x64}|token: ", "ghp_{b36}",
        "sk-{b40}", "AKIA{u16}", "xoxb-{d11}-{b24}", "eyJ{b40}", "AIza{b35}", "{b40}", "{b32}",
    ),
}
NEGATIVE = (
    "{w}_{w}_version_{y}{m}{t}_final", "{w}_{w}_{y}_{m}_{t}", "{w}-{w}-{d1}-{d2}-{w}", "IMG_{y}{m}{t}_{d6}", "{w}_{w}_{w}_v{d1}",
    "{w}_{w}_report_{y}", "MAX_{W}_{W}_COUNT", "{W}_{W}_{W}_{d1}", "{W}{W}{W}", "{W}_{d1}_{W}_{W}{W}",
    "{W}{d2}_{W}_{W}", "{W}-{W}-{d4}-{W}{W}", "{W}_{W}{W}_{y}", "{w}/{w}/{w}{d2}/{w}", "src/{w}/{w}_{w}{d1}",
    "{x40}|commit ", "{x40}|fixed in ", "{x40}|sha1: ", "{x64}|sha256:", "{x32}|md5 ", "{x40}", "{x64}", "{x40}|rev ", "{x32}",
    "{x8}-{x4}-{x4}-{x4}-{x12}", "{x8}-{x4}-{x4}-{x4}-{x12}|id: ", "{y}-{m}-{t}", "{y}-{m}-{t}|date: ", "{y}-{m}-{t}|key: ",
    "{y}{m}{t}", "{y}/{m}/{t}", "{t}.{m}.{y}", "{t}/{m}/{y}", "{y}-{y}", "{y}-{m}-{t} {d2}", "{d2} {d3} {d3}", "{d1} {d3} {d3} {d3}",
    "{d8}|order ", "{d10}|id ", "{d12}|invoice ", "978-{d1}-{d4}-{d4}-{d1}|isbn ", "978{d10}", "{d7}", "{d8}", "{d10}", "{d12}",
    "{d13}", "{d14}", "{d15}", "{d16}", "{d16}|card: ", "{d1}.{d2}.{d4}.{d1}", "{d4}px{d3}|width=", "{d6}kb|size: ", "{d7}|x=",
    "{w}.{w}{d1}|file: ", "{w}{d4}|chapter: ", "{w}.com|look at ", "{w}.{w}|is at ", "{w}.The|arrived at ", "{w}.org|{w} at ",
    "{w} dot {w}|the ", "{w}_{w}_{w}_{d2}|name=", "v{d1}.{d2}.{d3}-{w}|version: ",
)
_FORM = re.compile(r"\{([a-zA-Z])([0-9./]*)\}")
_HEXES, _ALNUM = "0123456789abcdef", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
_SETS = {"d": "0123456789", "x": _HEXES, "b": _ALNUM, "U": _ALNUM[:26], "u": _ALNUM[:26] + "0123456789"}


def planted(seed: int, each: int = 40, positive: dict | None = None, negative: tuple | None = None) -> list[tuple]:
    """Made-up sentences, each with a span of a format: (text, kind or None, start, end)."""
    draw = np.random.default_rng(seed)

    def word() -> str:
        return "".join(draw.choice(list("bcdfglmnprst")) + draw.choice(list("aeiou")) for _ in range(draw.integers(1, 5)))

    def fill(m: re.Match) -> str:
        what, n = m[1], m[2]
        if what in "wW":
            return word() if what == "w" else word().upper()
        if what == "k":
            own = "".join(map(str, [4, *draw.integers(0, 10, 14)]))
            own += next(c for c in "0123456789" if luhn(own + c))
            return n.join(own[k : k + 4] for k in range(0, 16, 4))
        if what == "y":
            return str(draw.integers(1950, 2040))
        if what in "mt":
            return f"{draw.integers(1, 13 if what == 'm' else 29):02d}"
        return "".join(draw.choice(list(_SETS[what]), int(n)))

    forms = [(k, f) for k, own in (POSITIVE if positive is None else positive).items() for f in own]
    forms += [(None, f) for f in (NEGATIVE if negative is None else negative)]
    out = []
    for kind, form in forms:
        shape, _, before = form.partition("|")
        for _ in range(each):
            words = [word() for _ in range(draw.integers(4, 16))]
            cut = int(draw.integers(1, len(words)))
            left = " ".join(words[:cut]) + str(draw.choice([" ", " ", ", ", "\n"])) + _FORM.sub(fill, before)
            span = _FORM.sub(fill, shape)
            quote = '"' if before.endswith('"') else ""
            out.append((left + span + quote + str(draw.choice([" ", " ", ", ", ". ", "\n"])) + " ".join(words[cut:]), kind, len(left), len(left) + len(span)))
    return out


def of_planted(rows: list[tuple]) -> list[tuple[int, str, list[float], int]]:
    """(row, kind, features, label) of what the generators propose in planted sentences beside base spans."""
    out = []
    for row, (text, kind, start, end) in enumerate(rows):
        base = base_spans(text)
        for c in candidates(text):
            if all(c[2] <= a or c[1] >= b for _, a, b in base):
                out.append((row, c[0], [float(v) for v in features(text, *c)], int(c == (kind, start, end))))
    return out


@dataclass
class Model:
    trees: boost.Boosted
    slope: float
    offset: float
    thresholds: dict[str, float]

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-(self.slope * self.trees.margin(x) + self.offset)))


def train(docs: DataFrame, sample: int = SAMPLE, beta: float = BETA) -> Model:
    """Fit on the planted and on at most `sample` labelled candidates.

    Scores are calibrated, and thresholds measured, on margins of trees that saw neither the part of
    the candidates nor the part of the planted formats they judge (one of `FOLDS`), so they tell of
    formats not met before.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows = []
            for d, t in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                base = set(base_spans(t))
                rows += [
                    (d, a, kind, y, (kind, a, b) in base, [float(v) for v in features(t, kind, a, b)])
                    for kind, a, b, y in labelled(t)
                ]
            columns = list(zip(*rows, strict=True)) or [()] * 6
            kinds = pa.int64(), pa.int64(), pa.string(), pa.int32(), pa.bool_(), pa.list_(pa.float64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["doc_id", "at", "kind", "y", "base", "x"]
            )

    found = texts(docs).mapInArrow(run, "doc_id long, at long, kind string, y int, base boolean, x array<double>")
    # the same number of each label at most, by the smallest hashes: a bounded sample, whatever the corpus
    draw = F.xxhash64(F.lit("sample"), "doc_id", "at", "kind")
    found = stored(found.select("y", "kind", "base", "x", draw.alias("draw")), "candidates")
    parts = [smallest(found.where(F.col("y") == y), sample // 2, "x") for y in (0, 1)]
    rows = sorted((r["draw"], r["y"], list(r["x"]), r["kind"], r["base"]) for r in parts[0].union(parts[1]).collect())
    rows += [(row // EACH, y, x, kind, False) for row, kind, x, y in of_planted(planted(seed=21, each=EACH))]
    y = np.array([r[1] for r in rows], float)
    x = np.array([r[2] for r in rows], float)
    fold = np.array([r[0] % FOLDS for r in rows])
    kinds, beyond = np.array([r[3] for r in rows]), ~np.array([r[4] for r in rows], bool)
    apart = np.empty(len(rows))
    for k in range(FOLDS):
        apart[fold == k] = boost.fit(x[fold != k], y[fold != k], **TREES).margin(x[fold == k])
    slope, offset = boost.calibrate(apart[beyond], y[beyond])
    p = 1 / (1 + np.exp(-(slope * apart + offset)))
    thresholds = {k: threshold(p[beyond & (kinds == k)], y[beyond & (kinds == k)], beta) for k in KINDS}
    return Model(boost.fit(x, y, **TREES), slope, offset, thresholds)


def threshold(p: np.ndarray, y: np.ndarray, beta: float) -> float:
    """The threshold of the best F measure, in which recall weighs `beta` times as much as precision:
    halfway, in log odds, to the next lower score.  Infinite where nothing is positive.
    """
    if not y.any():
        return float("inf")
    order = np.argsort(-p, kind="stable")
    right = np.cumsum(y[order])
    measure = (1 + beta**2) * right / (np.arange(1, len(order) + 1) + beta**2 * y.sum())
    last = np.append(np.diff(p[order]) != 0, True)  # equal scores pass together or not at all
    best = int(np.where(last, measure, -1.0).argmax())
    if best == len(order) - 1:
        return float(p[order][best]) * (1 - 1e-9)
    ends = p[order][[best, best + 1]].clip(1e-12, 1 - 1e-12)
    return float(1 / (1 + np.exp(-np.log(ends / (1 - ends)).mean())))


def chosen(text: str, base: list[tuple], proposed: list[tuple], score: np.ndarray, thresholds: dict) -> list[tuple]:
    """Base spans, and the likeliest candidates above their kind's threshold that overlap nothing taken."""
    taken = [(a, b) for _, a, b in base]
    out = [(*s, 1.0) for s in base]
    for k in np.argsort(-score, kind="stable"):
        kind, a, b = proposed[k]
        if score[k] >= thresholds[kind] and all(b <= x or a >= y for x, y in taken):
            taken.append((a, b))
            out.append((kind, a, b, float(score[k])))
    return in_order(out)


def spans_of(text: str, model: Model) -> tuple[list[tuple], list[tuple]]:
    """Base spans of a text, and all that is chosen with its scores."""
    base = base_spans(text)
    new = [c for c in candidates(text) if all(c[2] <= a or c[1] >= b for _, a, b in base)]
    score = model.scores(np.array([features(text, *c) for c in new], float)) if new else np.zeros(0)
    return base, chosen(text, base, new, score, model.thresholds)


def find(docs: DataFrame, model: Model | None = None, **training: float) -> DataFrame:
    """(doc_id, text, base, spans): spans as structs of kind, start and end (code points), score."""
    model = model or train(docs, **training)
    span = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            base_out, out = [], []
            for text in batch.column("text").to_pylist():
                base, got = spans_of(text, model)
                names = ("kind", "start", "end", "score")
                base_out.append([dict(zip(names, (*s, 1.0), strict=True)) for s in base])
                out.append([dict(zip(names, s, strict=True)) for s in got])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text"), pa.array(base_out, span), pa.array(out, span)],
                ["doc_id", "text", "base", "spans"],
            )

    kind = "array<struct<kind:string,start:long,end:long,score:double>>"
    return texts(docs).mapInArrow(run, f"doc_id long, text string, base {kind}, spans {kind}")


def redact(docs: DataFrame, model: Model | None = None, **training: float) -> DataFrame:
    """`docs` with each span's text replaced by its kind in angle brackets; null texts stay null."""
    model = model or train(docs, **training)
    schema = docs.schema
    at = docs.columns.index("text")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            out = []
            for text in batch.column(at).to_pylist():
                if text is not None:
                    text = covered(text, spans_of(text, model)[1])
                out.append(text)
            columns = [pa.array(out, pa.string()) if k == at else c for k, c in enumerate(batch.columns)]
            yield pa.RecordBatch.from_arrays(columns, batch.schema.names)

    return docs.withColumn("text", docs["text"].cast("string")).mapInArrow(run, schema)


def covered(text: str, spans: list[tuple]) -> str:
    """The text with spans replaced; spans that overlap become one, of the first one's kind."""
    out, at = [], 0
    for kind, a, b, _ in spans:
        if a >= at:
            out += [text[at:a], f"<{kind.upper()}>"]
        at = max(at, b)
    return "".join(out) + text[at:]
