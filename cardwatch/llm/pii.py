"""Personal data by weak supervision, in DataFrame operations only.

Candidates are spans that a strict or a loose pattern finds.  Labelers vote on
each: strict pattern, validity (check digits, ranges, lengths), gazetteer (top
level domains, card issuers, country codes), words before it that speak for or
against, and clean edges.  Expectation-maximisation over the counts of vote
patterns in all documents estimates how reliable each labeler is; its
posteriors train a logistic span classifier over votes, kind and length, which
is compiled into a column expression.

Base spans (email, ip, card, phone that pass their checks) always stay; the
classifier adds loose candidates that overlap no base span.

Defined results: null and empty texts have no span; an empty table gives an
empty result (and a model that adds nothing); repeated rows are treated alike;
extra columns are passed through, columns named like a result are replaced.

Scale: training reduces all candidates to counts by vote pattern and length
class with partial aggregation (at most a few thousand rows, whatever the
input); scoring is one pass without a shuffle.  The patterns use possessive
runs and run starts, so their time is linear in the text.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cardwatch.llm import common
from cardwatch.llm.spans import digits, joined, let, luhn, matches, replaced

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "email_at", "ipv6", "card_short", "phone_local", "ssn", "iban")
LOCAL = "[A-Za-z0-9._%+-]"

# The four base patterns find what their plain forms find: a run can only start a match where the run starts or where
# the last match ended, and possessive runs don't change a match as nothing that follows could take from them.
PATTERNS = {
    "email": rf"(?:(?<!{LOCAL})|\G){LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "email_at": rf"(?<!{LOCAL}){LOCAL}++\x20?[\[(]at[\])]\x20?[A-Za-z0-9-]++(?:(?:\.|\x20?[\[(]dot[\])]\x20?)[A-Za-z0-9-]++)++",
    "ipv6": r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])",
    "card_short": r"(?<![0-9])[0-9]{4}[\x20-][0-9]{6}[\x20-][0-9]{5}(?![0-9])",
    "phone_local": r"(?<![0-9+])(?:\([0-9]{3}\)\x20?|[0-9]{3}[.\x20-])[0-9]{3}[.\x20-][0-9]{4}(?![0-9])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){3,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
}
PART = "0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"

# Gazetteers and cue words.
DOMAINS = ("com", "org", "net", "edu", "gov", "info", "io", "de", "fr", "es", "it", "uk", "us", "eu", "ch", "at", "nl")
COUNTRY_CODES = ("1", "7", "20", "27", "30", "31", "32", "33", "34", "36", "39", "40", "41", "43", "44", "45", "46", "47", "48",
                 "49", "51", "52", "54", "55", "56", "57", "61", "62", "63", "64", "65", "66", "81", "82", "84", "86", "90", "91")
SPEAKS_FOR = ("mail", "contact", "contacto", "kontakt", "phone", "tel", "call", "fax", "mobile", "handy", "anruf", "card", "visa",
              "karte", "carte", "tarjeta", "ip", "address", "adresse", "server", "ssn", "iban", "account", "konto")
SPEAKS_AGAINST = ("version", "release", "isbn", "issn", "order", "invoice", "article", "section", "build", "doi", "page", "part no")
VOTERS = ("pattern", "valid", "gazetteer", "context_for", "context_against", "edges")


def _vote(yes: Column, no: Column | None = None) -> Column:
    """'1' for, '0' against, '-' for no opinion."""
    out = F.when(yes, "1")
    return F.coalesce(out.when(no, "0") if no is not None else out, F.lit("-")) if no is not None else F.coalesce(out, F.lit("0"))


def _valid(kind: str, v: Column) -> Column:
    n = F.length(digits(v))
    return {
        "email": lambda: F.substring_index(v, ".", -1).rlike("^[A-Za-z]{2,}$"),
        "ip": lambda: v.rlike(rf"^{PART}(?:\.{PART}){{3}}$"),
        "card": lambda: F.when(n.between(16, 19), luhn(v)).otherwise(F.lit(False)),
        "phone": lambda: n.between(8, 15),
        "email_at": lambda: F.right(v, F.lit(2)).rlike("^[A-Za-z]{2}$"),
        "ipv6": lambda: v.rlike("[0-9]"),
        "card_short": lambda: luhn(v),
        "phone_local": lambda: ~digits(v).rlike(r"^[01]|^...[01]|^([0-9])\1{9}$"),
        "ssn": lambda: ~v.rlike("^(?:000|666|9..)|-00-|-0000$"),
        "iban": lambda: F.length(F.regexp_replace(v, " ", "")).between(15, 34),
    }[kind]()


def _listed(kind: str, v: Column) -> Column:
    """The gazetteer's answer, null where none applies."""
    d = digits(v)
    if kind in ("email", "email_at"):
        return F.lower(F.regexp_extract(F.right(v, F.lit(12)), "([A-Za-z]+)$", 1)).isin(*DOMAINS)
    if kind in ("card", "card_short"):
        return d.rlike("^(?:4|5[1-5]|2[2-7]|3[47]|6011|65)")
    if kind == "phone":
        return d.rlike(f"^(?:{'|'.join(COUNTRY_CODES)})")
    if kind == "ip":
        return ~v.rlike(r"^(?:0|127|255|22[4-9]|2[34][0-9])\.")
    return F.lit(None).cast("boolean")


def _passes(kind: str, v: Column) -> Column:
    """The contract's check of a base kind."""
    return F.lit(True) if kind == "email" else _valid(kind, v)


def _cue(words: tuple[str, ...]) -> str:
    return rf"(?i)(?<![a-z])(?:{'|'.join(words)})[a-z]{{0,3}}[^a-z0-9]{{0,4}}(?:[a-z]{{1,8}}[^a-z0-9]{{0,4}})?$"


def _candidates(kind: str, text: Column, gate: Column) -> Column:
    """Matches of one kind as spans: kind, start, end, base, votes and length class."""
    base = kind in BASE_KINDS

    def span(m: Column) -> Column:
        v = m["value"]
        ok = _passes(kind, v) if base else F.lit(False)
        listed = _listed(kind, v)
        votes = F.concat(
            _vote(ok), _vote(_valid(kind, v)), _vote(listed, ~listed),
            _vote(m["before"].rlike(_cue(SPEAKS_FOR)), F.lit(False)),
            _vote(F.lit(False), m["before"].rlike(_cue(SPEAKS_AGAINST))),
            _vote(~(m["before"].rlike("[A-Za-z0-9]$") | m["after"].rlike("^[A-Za-z0-9]"))))
        return F.struct(F.lit(kind).alias("kind"), m["start"].alias("start"), m["end"].alias("end"), ok.alias("base"),
                        votes.alias("votes"), F.least(F.length(v) / F.lit(6), F.lit(7)).cast("int").alias("size"))

    return F.transform(matches(text, gate, PATTERNS[kind]), span)


def candidates(text: Column) -> dict[str, Column]:
    """Candidate spans of a text by kind; base matches that fail their check are candidates that can't be added."""
    number = text.rlike("[0-9]")
    gates = {"email": F.contains(text, F.lit("@")), "ip": text.rlike(r"[0-9]\.[0-9]"), "card": number,
             "phone": F.contains(text, F.lit("+")), "email_at": F.contains(text, F.lit("(at)")) | F.contains(text, F.lit("[at]")),
             "ipv6": F.contains(text, F.lit(":")) & number, "card_short": number, "phone_local": number,
             "ssn": number & F.contains(text, F.lit("-")), "iban": number}
    return {k: _candidates(k, text, gates[k]) for k in KINDS}


@dataclass
class Model:
    """Reliabilities (per voter: how often right on personal and on other spans) and the classifier's weights."""

    reliability: dict[str, tuple[float, float]] = field(default_factory=dict)
    weights: dict[str, float] = field(default_factory=dict)

    def log_odds(self, span: Column) -> Column:
        if not self.weights:
            return F.lit(-10.0)
        w = self.weights
        parts = [F.lit(w.get("bias", 0.0))]
        for name, value in [(f"kind={k}", span["kind"] == k) for k in KINDS] + [(f"size={n}", span["size"] == n) for n in range(8)]:
            if w.get(name):
                parts.append(F.when(value, w[name]).otherwise(0.0))
        for i, voter in enumerate(VOTERS):
            got = F.substring(span["votes"], i + 1, 1)
            parts.append(F.when(got == "1", w.get(f"{voter}=1", 0.0)).when(got == "0", w.get(f"{voter}=0", 0.0)).otherwise(0.0))
        return reduce(lambda a, b: a + b, parts)


def _sigmoid(x: float) -> float:
    return 1 / (1 + math.exp(-max(-30.0, min(30.0, x))))


def estimate(counts: list[tuple[str, str, int, int]], rounds: int = 50) -> Model:
    """EM over (kind, votes, size class, count), then logistic weights for the posteriors."""
    if not counts:
        return Model()
    patterns: dict[tuple[str, str], int] = {}
    for kind, votes, _, n in counts:
        patterns[kind, votes] = patterns.get((kind, votes), 0) + n
    right = {v: (0.85, 0.85) for v in VOTERS}
    prior = {k: 0.5 for k in KINDS}
    post: dict[tuple[str, str], float] = {}
    for _ in range(rounds):
        for (kind, votes), _n in patterns.items():
            x = math.log(prior[kind] / (1 - prior[kind]))
            for voter, v in zip(VOTERS, votes):
                yes, no = right[voter]
                if v != "-":
                    x += math.log(yes / (1 - no)) if v == "1" else math.log((1 - yes) / no)
            post[kind, votes] = _sigmoid(x)
        for k in KINDS:
            mass = sum(n for (kind, _), n in patterns.items() if kind == k)
            hit = sum(n * post[p] for p, n in patterns.items() if p[0] == k)
            prior[k] = min(0.99, max(0.01, (hit + 2) / (mass + 4)))
        for i, voter in enumerate(VOTERS):
            # a voter is taken to be right 17 times in 20 before any span is seen
            a = [17.0, 3.0, 17.0, 3.0]
            for (kind, votes), n in patterns.items():
                p = post[kind, votes]
                if votes[i] != "-":
                    a[0 if votes[i] == "1" else 1] += n * p
                    a[3 if votes[i] == "1" else 2] += n * (1 - p)
            right[voter] = (min(0.99, max(0.51, a[0] / (a[0] + a[1]))), min(0.99, max(0.51, a[2] / (a[2] + a[3]))))
    return Model(right, _logistic([(k, v, s, n, post[k, v]) for k, v, s, n in counts]))


def _logistic(rows: list[tuple[str, str, int, int, float]], rounds: int = 300) -> dict[str, float]:
    """Weighted logistic fit to soft labels (rows are vote patterns, so few), by gradient steps on the mean loss."""
    total = float(sum(r[3] for r in rows))
    coded = [(["bias", f"kind={k}", f"size={s}"] + [f"{voter}={v}" for voter, v in zip(VOTERS, votes) if v != "-"], n / total, y)
             for k, votes, s, n, y in rows]
    w: dict[str, float] = {f: 0.0 for names, _, _ in coded for f in names}
    for _ in range(rounds):
        grad = {f: -1e-4 * x for f, x in w.items()}
        for names, weight, y in coded:
            off = weight * (y - _sigmoid(sum(w[f] for f in names)))
            for f in names:
                grad[f] += off
        for f, g in grad.items():
            w[f] += 2.0 * g
    return w


def train(docs: DataFrame, text_col: str = "text") -> Model:
    """Reliabilities and classifier from the candidates of all documents."""
    spans = candidates(common.quoted(text_col))
    rows = (docs.select(F.explode(F.concat(*spans.values())).alias("s"))
            .groupBy("s.kind", "s.votes", "s.size").agg(F.count("*").alias("n")).collect())  # bounded by kinds, votes and sizes
    return estimate(sorted((r["kind"], r["votes"], r["size"], r["n"]) for r in rows))


def find(docs: DataFrame, model: Model, text_col: str = "text", cut: float = 0.5) -> DataFrame:
    """``docs`` with ``pii_spans``, ordered by kind and start: kind, start, end and base (false for what the classifier added)."""
    docs = common.without(docs, "pii_spans")
    found = candidates(common.quoted(text_col))
    base = F.concat(*[F.filter(found[k], lambda s: s["base"]) for k in BASE_KINDS])
    loose = F.concat(*[found[k] for k in KINDS if k not in BASE_KINDS])
    fields = lambda s, b: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"), F.lit(b).alias("base"))
    limit = math.log(cut / (1 - cut))

    def both(s: Column) -> Column:
        clear = lambda x: ~F.exists(s["base"], lambda b: (b["start"] < x["end"]) & (x["start"] < b["end"]))
        more = F.filter(s["loose"], lambda x: (model.log_odds(x) >= limit) & clear(x))
        return F.concat(F.transform(s["base"], lambda x: fields(x, True)), F.transform(more, lambda x: fields(x, False)))

    return docs.withColumn("pii_spans", let(F.struct(base.alias("base"), loose.alias("loose")), both))


def redact(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` with every span of the text replaced by its kind, such as ``<EMAIL>``."""
    name = "__pii_spans"
    marked = find(docs, model, text_col).withColumnRenamed("pii_spans", name) if "pii_spans" not in docs.columns else None
    if marked is None:
        marked = find(docs.withColumnRenamed("pii_spans", "__own"), model, text_col).withColumnRenamed("pii_spans", name).withColumnRenamed("__own", "pii_spans")
    by_start = F.sort_array(F.transform(name, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))
    return marked.withColumn(text_col, replaced(common.quoted(text_col), by_start)).drop(name)


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document."""
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text")
    found = find(docs, train(docs)).select("doc_id", "pii_spans")
    count = lambda k: F.size(F.filter("pii_spans", lambda s: s["base"] & (s["kind"] == k))).cast("long").alias(f"n_{k}")
    return found.select("doc_id", *[count(k) for k in BASE_KINDS],
                        F.sha2(joined(F.filter("pii_spans", lambda s: s["base"])), 256).alias("base_sha256"),
                        joined(F.col("pii_spans")).alias("spans"))
