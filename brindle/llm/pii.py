"""Personal data by weak supervision: labelers vote, EM weighs them, a classifier trained on that decides.

Candidates come from wide patterns. Regex, gazetteer, context, neighbourhood and boundary labelers vote on each. The
votes' patterns are counted over all documents (their number is bounded by the labelers, not by the corpus), an
expectation-maximisation with a reliability for each labeler, kind and class gives each pattern a probability, and a
logistic regression on votes and shape, trained on those, decides on each span. Spans that pass the strict patterns of
the base kinds always stay.
"""

from __future__ import annotations

import bisect
import hashlib
import re
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from brindle.llm import common

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "secret", "ssn", "iban", "account", "person", "address")
#: Gazetteers and trigger words.
TLDS = set("com org net edu gov mil int info biz io ai co uk de fr es it nl be ch at pl pt se no fi dk ie us ca au nz jp cn in br mx ru eu example test".split())
CALLING = ("1", "7", "20", "27", "30", "31", "32", "33", "34", "36", "39", "40", "41", "43", "44", "45", "46", "47", "48", "49", "51", "52", "55", "61", "62", "64", "65", "81", "82", "86", "90", "91", "351", "352", "353", "358", "380", "420", "421")
ISSUERS = ("34", "37", "4", "51", "52", "53", "54", "55", "22", "23", "24", "25", "26", "27", "60", "64", "65", "35", "36", "38")
TRIGGERS = {
    "email": "mail e-mail email contact reach write address".split(),
    "ip": "ip host server addr address client login".split(),
    "card": "card visa mastercard amex credit debit payment pan".split(),
    "phone": "phone tel call mobile cell fax telefon teléfono tél".split(),
    "secret": "key secret token access aws credential password".split(),
    "ssn": "ssn social security".split(),
    "iban": "iban account bank konto".split(),
    "account": "card account number credit debit payment konto compte cuenta no nr".split(),
    "person": "dear from to by name signed contact author patient client".split(),
    "address": "at address live lives home office street visit mail".split(),
}
GIVEN = set("anna anne maria john mary james peter paul david michael thomas robert william sarah laura julia emma sophie marie jean pierre luc hans karl klaus uwe jose juan carlos luis ana carmen elena lucia marta".split())
STREETS = "street|st|avenue|ave|road|rd|lane|ln|drive|dr|boulevard|blvd|court|square|way"
AGAINST = set("version ver isbn doi v release section chapter build order serial".split())

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile("[0-9]")
_WIDE = {
    "email": re.compile(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64} ?(?:\(at\)|\[at\]) ?[A-Za-z0-9-]{1,63}(?: ?(?:\.|\(dot\)|\[dot\]) ?[A-Za-z0-9-]{1,63}){1,4}", re.I),
    "phone": re.compile(r"(?<![0-9+])(?:\([0-9]{3}\) ?|[0-9]{3}[-.])[0-9]{3}[-.][0-9]{4}(?![0-9])"),
    "secret": re.compile(
        r"(?<![A-Za-z0-9])(?:(?:AKIA|ASIA)[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36}|xox[abprs]-[A-Za-z0-9-]{10,200}|sk-[A-Za-z0-9_-]{20,200})(?![A-Za-z0-9])"
        r"|(?<![A-Za-z0-9])(?i:token|secret|passw(?:or)?d|pwd|[a-z0-9_-]{0,20}key|credential|authorization)[\x22']?[\x20\t]{0,3}[:=][\x20\t]{0,3}[\x22']?(?P<value>(?=[A-Za-z_./+-]{0,200}[0-9])[A-Za-z0-9_./+=-]{8,512})"
        r"|(?<![A-Za-z0-9])[0-9a-fA-F]{32,128}(?![A-Za-z0-9])"
    ),
    "ssn": re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"),
    "iban": re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"),
    "account": re.compile(r"(?<![A-Za-z0-9.])[0-9]{4}(?:[\x20-]?[0-9]{4}){2}[\x20-]?[0-9]{1,7}(?![A-Za-z0-9]|\.[0-9])"),
    "person": re.compile(r"(?<!\w)(?:Mr|Mrs|Ms|Dr|Prof|Herr|Frau|Monsieur|Madame|Señora?)\.? [^\W\d_a-zß-ÿ][^\W\d_]{1,30}(?: [^\W\d_a-zß-ÿ][^\W\d_]{1,30})?"),
    "address": re.compile(rf"(?<![\w.,-])[0-9]{{1,5}} (?:[A-Z][A-Za-z]{{1,30}} ){{1,3}}(?i:{STREETS})(?![A-Za-z])"),
}
#: What a text must hold, in lower case, for the wide patterns to be tried.
_SIGNS = {"email": ("at)", "at]"), "person": ("mr", "ms", "dr", "prof", "herr", "frau", "monsieur", "madame", "señor")}


def emails(text: str) -> list[tuple[int, int]]:
    """Matches of the e-mail pattern, leftmost and not overlapping. A match ends its local part at a sign @, and starts
    with the run of local signs before it, so that runs are read once, however long."""
    out, free, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            out.append((start, m.end()))
            free = m.end()
        at = text.find("@", max(at + 1, free))
    return out


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans of the four base kinds: strict matches only; a match that fails its check is dropped."""
    out = [("email", a, b) for a, b in emails(text)] if "@" in text else []
    if not _DIGIT.search(text):
        return out
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0")[:3] or "0") <= 255 for p in m[0].split(".")):
            out.append(("ip", m.start(), m.end()))
    for m in _CARD.finditer(text):
        if 13 <= m.end() - m.start() and 13 <= len(d := _digits(m[0])) <= 19 and luhn(d):
            out.append(("card", m.start(), m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= len(_digits(m[0])) <= 15:
                out.append(("phone", m.start(), m.end()))
    return out


def candidates(text: str) -> list[dict]:
    """Base spans, and what the wide patterns find beside them, each with votes (-1, 0, 1) and a shape. Of spans that
    overlap the first found stays: base spans, then kinds in order."""
    base = base_spans(text)
    found = [(k, a, b, True) for k, a, b in base]
    has_digit = bool(_DIGIT.search(text))
    low = text.lower()
    taken = sorted((a, b) for _, a, b in base)
    for kind, pattern in _WIDE.items():
        signs = _SIGNS.get(kind)
        if not (has_digit if signs is None else any(x in low for x in signs)):
            continue
        for m in pattern.finditer(text):
            a, b = m.span("value") if kind == "secret" and m["value"] else m.span()
            at = bisect.bisect_left(taken, (a, a))
            if not (at and taken[at - 1][1] > a or at < len(taken) and taken[at][0] < b):
                found.append((kind, a, b, False))
                taken.insert(at, (a, b))
    kinds = {k for k, *_ in found}
    return [{"kind": k, "start": a, "end": b, "base": strict, "votes": votes(text, k, a, b, strict, len(kinds)), "shape": min(7, (b - a) // 5)} for k, a, b, strict in found]


def votes(text: str, kind: str, start: int, end: int, strict: bool, kinds: int) -> str:
    """One sign a labeler: regex, gazetteer, context, neighbourhood, boundary. + for, - against, 0 no vote."""
    span = text[start:end]
    digits = _digits(span)
    if kind == "email":
        known = span.rsplit(".", 1)[-1].lower().strip(" )]") in TLDS
    elif kind == "card":
        known = digits.startswith(ISSUERS)
    elif kind == "phone":
        known = digits.startswith(CALLING) if span.startswith("+") else digits[0] not in "01" and digits[3] not in "01"
    elif kind == "ip":
        known = int(digits[:1] or 0) > 0 and not span.startswith(("127.", "255.", "0."))
    elif kind == "ssn":
        known = span[:3] not in ("000", "666") and span[0] != "9" and span[4:6] != "00"
    elif kind == "iban":
        plain = re.sub(" ", "", span)
        known = int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 == 1
    elif kind == "account":
        known = len(digits) in (14, 15, 16) or digits.startswith(ISSUERS)
    elif kind == "person":
        known = bool(GIVEN & set(span.lower().split()))
    elif kind == "address":
        known = span[0] != "0"
    else:  # not a word or a number alone
        known = len(set(span)) > 5 and not span.isalpha() and (len(span) >= 16 or not span.isdigit())
    words = re.findall(r"[^\W\d_]+(?:-[^\W\d_]+)*", text[max(0, start - 40) : start].lower())[-5:]
    if kind == "secret":
        words += [w for x in words for w in re.split("[_-]", x)]
    context = "+" if set(words) & set(TRIGGERS[kind]) else "-" if set(words) & AGAINST else "0"
    inside = (start and text[start - 1].isalnum()) or (end < len(text) and text[end].isalnum())
    return ("+" if strict or kind in ("secret", "ssn") or kind == "account" and len(digits) == 16 else "0") + ("+" if known else "-") + context + ("+" if kinds > 1 else "0") + ("-" if inside else "+")


ROW = T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType()), T.StructField("base", T.BooleanType()), T.StructField("votes", T.StringType()), T.StructField("shape", T.LongType())])


def labelled(df: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """Rows (doc_id, found): each row's candidates with their votes; none for a null or empty text."""
    schema = T.StructType([T.StructField("doc_id", df.schema[id_col].dataType), T.StructField("found", T.ArrayType(ROW))])

    def run(batch):
        return common.batch(schema, [batch.column(0), [candidates(t.as_py() or "") for t in batch.column(1)]])

    return common.map_batches(common.ids_and_texts(df, id_col, text_col), run, schema)


@dataclass
class Model:
    """Reliabilities by kind, and the classifier's weights."""

    reliability: dict[str, np.ndarray]  # kind -> labelers x classes x votes
    weights: np.ndarray

    def accepts(self, kind: str, votes_: str, shape: int, base: bool) -> bool:
        return base or float(_features(kind, votes_, shape) @ self.weights) > 0


LABELERS = 5


def _features(kind: str, votes_: str, shape: int) -> np.ndarray:
    x = np.zeros(len(KINDS) + 3 * LABELERS + 8)
    x[KINDS.index(kind)] = 1
    for j, v in enumerate(votes_):
        x[len(KINDS) + 3 * j + "-0+".index(v)] = 1
    x[len(KINDS) + 3 * LABELERS + shape] = 1
    return x


def fit(patterns: list[tuple[str, str, int, int]], rounds: int = 60) -> Model:
    """From counted patterns (kind, votes, shape, count), over all candidates."""
    reliability: dict[str, np.ndarray] = {}
    posterior: dict[tuple[str, str], float] = {}
    for kind in KINDS:
        counts: dict[str, int] = {}
        for k, v, _, n in patterns:
            if k == kind:
                counts[v] = counts.get(v, 0) + n
        if not counts:
            continue
        keys = sorted(counts)
        n = np.array([counts[k] for k in keys], float)
        seen = np.array([["-0+".index(c) for c in k] for k in keys])
        # start: a majority of votes, with labelers better than chance
        p = 1 / (1 + np.exp(-(seen - 1).sum(1)))
        for _ in range(rounds):
            prior = np.clip((n * p).sum() / n.sum(), 0.02, 0.98)
            theta = np.zeros((LABELERS, 2, 3))
            for j in range(LABELERS):
                for c, w in ((0, n * (1 - p)), (1, n * p)):
                    # a few votes of a prior that a vote for speaks for, so that small counts do not turn a labeler round
                    theta[j, c] = np.bincount(seen[:, j], weights=w, minlength=3) + (np.array([2, 3, 1]) if c == 0 else np.array([1, 3, 2]))
                    theta[j, c] /= theta[j, c].sum()
            log = sum(np.log(theta[j, 1, seen[:, j]]) - np.log(theta[j, 0, seen[:, j]]) for j in range(LABELERS)) + np.log(prior / (1 - prior))
            p = 1 / (1 + np.exp(-np.clip(log, -30, 30)))
        reliability[kind] = theta
        posterior |= {(kind, k): float(v) for k, v in zip(keys, p)}
    weights = np.zeros(len(KINDS) + 3 * LABELERS + 8)
    if patterns:
        x = np.array([_features(k, v, s) for k, v, s, _ in patterns])
        y = np.array([posterior[k, v] for k, v, _, _ in patterns])
        n = np.array([c for *_, c in patterns], float)
        n /= n.sum()
        for _ in range(100):  # Newton steps of a ridge logistic regression on soft labels
            q = 1 / (1 + np.exp(-x @ weights))
            grad = x.T @ (n * (q - y)) + 1e-4 * weights
            hess = (x * (n * q * (1 - q))[:, None]).T @ x + 1e-4 * np.eye(len(weights))
            step = np.linalg.solve(hess, grad)
            weights -= step
            if np.abs(step).max() < 1e-6:
                break
    return Model(reliability, weights)


def train(rows: DataFrame) -> Model:
    """Counts the patterns of all candidates of ``labelled`` rows; at most a few thousand reach the driver."""
    spans = rows.select(F.explode("found").alias("s"))
    counted = spans.groupBy("s.kind", "s.votes", "s.shape").agg(F.count("*").alias("n")).orderBy("kind", "votes", "shape").collect()
    return fit([(r["kind"], r["votes"], r["shape"], r["n"]) for r in counted])


def _joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in sorted(spans, key=lambda s: (KINDS.index(s[0]), s[1])))


def report(df: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """Rows (doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_spans, n_added), one for each row, repeated
    rows included.

    Offsets are code points. n_spans counts all spans, n_added those that the method adds to the base ones: obfuscated
    e-mail, phone numbers without +, keys and tokens, social security numbers, IBANs, long numbers that fail the check
    digit, persons and addresses, where the classifier accepts them. A null or empty text has no spans. Null ids stay
    null; extra columns are not read; an empty table gives no rows.
    """
    rows = common.staged(labelled(df, text_col, id_col), "pii-labelled")
    model = train(rows)
    long, string = T.LongType(), T.StringType()
    schema = T.StructType([rows.schema["doc_id"], *(T.StructField(f"n_{k}", long) for k in BASE_KINDS), T.StructField("base_sha256", string), T.StructField("spans", string), T.StructField("n_spans", long), T.StructField("n_added", long)])

    def run(batch):
        out: list[list] = [[] for _ in range(8)]
        for found in batch.column(1).to_pylist():
            base = [(s["kind"], s["start"], s["end"]) for s in found if s["base"]]
            spans = [(s["kind"], s["start"], s["end"]) for s in found if model.accepts(s["kind"], s["votes"], s["shape"], s["base"])]
            kinds = [k for k, *_ in base]
            for c, v in zip(out, (*(kinds.count(k) for k in BASE_KINDS), hashlib.sha256(_joined(base).encode()).hexdigest(), _joined(spans), len(spans), len(spans) - len(base))):
                c.append(v)
        return common.batch(schema, [batch.column(0), *out])

    return common.map_batches(rows, run, schema)


def redacted(df: DataFrame, text_col: str = "text", length_col: str = "n_chars") -> DataFrame:
    """``df`` with each span in its text replaced by its kind in brackets; ``length_col``, where there is one, follows.
    Rows and other columns stay; a null text stays null. Texts are read twice, to train and to redact."""
    model = train(labelled(df.select(F.lit(0).alias("doc_id"), F.col(text_col).alias("text"))))
    names = df.columns

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            texts = batch.column(names.index(text_col)).to_pylist()
            for i, text in enumerate(texts):
                if not text:
                    continue
                spans = sorted((s["start"], s["end"], s["kind"]) for s in candidates(text) if model.accepts(s["kind"], s["votes"], s["shape"], s["base"]))
                at, parts = 0, []
                for a, b, kind in spans:
                    if b > at:
                        parts += [text[at : max(a, at)], f"[{kind.upper()}]"]
                        at = b
                if parts:
                    texts[i] = "".join(parts) + text[at:]
            columns = list(batch.columns)
            columns[names.index(text_col)] = pa.array(texts, batch.schema.field(text_col).type)
            if length_col in names:
                k = names.index(length_col)
                old = batch.column(k).to_pylist()
                columns[k] = pa.array([len(t) if t is not None and t != b.as_py() else o for t, b, o in zip(texts, batch.column(names.index(text_col)), old)], batch.schema.field(length_col).type)
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)
        common.trim()

    common.bound_batches(df.sparkSession)
    return df.mapInArrow(run, df.schema)
