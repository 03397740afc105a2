"""URL filters: host rules, and a weighted vocabulary of URL terms.

One Aho-Corasick pass over a URL finds all terms; a hit counts only between
boundaries (no letter or digit beside it). One strict term blocks, and so do
soft terms whose weights, each distinct term once, reach the threshold. A rule
for the host decides before the vocabulary.

Rules and terms are parameters of bounded number, held in each task; pages are
judged where they are read and nothing is shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

# The host rules of the contract (action, rule) and the vocabulary.
RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))
STRICT = ("adult", "bestiality", "camgirls", "casino", "cialis", "escort", "escorts", "gangbang", "hardcore-sex", "hentai",
          "jackpot", "keylogger", "live-sex", "malware", "milf", "nudes", "onlyfans-leaks", "payday-loans", "phishing", "porn",
          "porno", "pornography", "replica-watches", "sex-cams", "sexcam", "sexchat", "slot-machine", "slots", "spam", "spyware",
          "torrents", "tramadol", "viagra", "warez", "webcam-sex", "xanax", "xxx", "xxx-videos")
SOFT = {"ads": 1.0, "affiliate": 1.0, "aff": 0.5, "babes": 1.0, "baccarat": 1.5, "backlinks": 1.0, "banner": 0.5, "bet": 1.0,
        "bets": 1.0, "betting": 1.0, "bingo": 1.0, "blackjack": 1.5, "bonus": 1.0, "bookmaker": 1.5, "buy": 0.5, "buy-now": 1.0,
        "cash": 0.5, "cheap": 1.0, "cheats": 1.0, "click": 0.5, "clickbait": 1.0, "clicks": 1.0, "coupon": 1.0, "coupons": 1.0,
        "crack": 1.0, "cracked": 1.0, "credit": 0.5, "dating": 1.0, "deal": 0.5, "deals": 0.5, "diet": 0.5, "discount": 1.0,
        "doorway": 1.0, "download-now": 1.0, "earn": 0.5, "earn-money": 1.5, "essay": 0.5, "farm": 1.0, "followers": 0.5,
        "forex": 1.0, "free": 1.0, "gamble": 1.5, "gambling": 1.5, "gift-card": 1.0, "giveaway": 1.0, "hack": 0.5, "hacks": 1.0,
        "hot": 0.5, "keygen": 1.5, "lingerie": 1.0, "loan": 1.0, "loans": 1.0, "lottery": 1.5, "lotto": 1.5, "make-money": 1.5,
        "mortgage": 0.5, "naked": 1.0, "nude": 1.0, "nulled": 1.5, "offer": 0.5, "offers": 0.5, "payday": 1.0, "penis": 1.0,
        "pharmacy": 1.0, "pills": 1.0, "poker": 1.5, "popup": 1.0, "prize": 1.0, "promo": 1.0, "redirect": 0.5, "refinance": 1.0,
        "replica": 1.0, "ringtones": 1.0, "roulette": 1.5, "seo": 0.5, "serial-key": 1.5, "sex": 1.5, "sexy": 1.0, "singles": 0.5,
        "slim": 0.5, "sponsored": 1.0, "sweepstakes": 1.5, "torrent": 1.0, "track": 1.0, "tracker": 0.5, "traffic": 0.5,
        "utm": 0.5, "voucher": 1.0, "weight-loss": 1.0, "win": 1.0, "winner": 1.0}
SOFT_LIMIT = 2.0
#: Most rules or terms one filter takes; each task holds them.
MAX_ENTRIES = 100_000


def host_and_path(url: str | None) -> tuple[str, str]:
    """Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, with
    A-Z lower-cased. Path: from there up to ``?``, ``#`` or the end. Both are
    empty for null and without ``://``."""
    _, found, rest = (url or "").partition("://")
    if not found:
        return "", ""
    cuts = [i for c in "?#" if (i := rest.find(c)) >= 0]
    rest = rest[:min(cuts)] if cuts else rest
    host, slash, path = rest.partition("/")
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), slash + path


class UrlJudge:
    """Verdicts of one set of rules and terms."""

    def __init__(self, rules: Sequence[tuple[str, str]], strict: Sequence[str], soft: Mapping[str, float],
                 limit: float):
        if max(len(rules), len(strict) + len(soft)) > MAX_ENTRIES:
            raise ValueError(f"at most {MAX_ENTRIES} rules and terms")
        self.by_host: dict[str, list[tuple[str, str, str]]] = {}
        for action, rule in rules:
            host, slash, path = rule.partition("/")
            self.by_host.setdefault(host.lower(), []).append((slash + path, rule, action))
        self.limit = limit
        self.terms = ahocorasick.Automaton()
        for term, weight in [*soft.items(), *((t, float("inf")) for t in strict)]:
            self.terms.add_word(term.lower(), (term.lower(), weight))
        if len(self.terms):
            self.terms.make_automaton()

    def rule(self, host: str, path: str) -> tuple[str, str] | None:
        """The longest rule that fits (ties: the longer host) and its action."""
        best = None
        at = 0
        while True:
            suffix = host[at:]
            for start, rule, action in self.by_host.get(suffix, ()):
                if path.startswith(start) and (best is None or len(rule) > len(best[0])):
                    best = (rule, action)
            at = host.find(".", at) + 1
            if at == 0:
                return best

    def hits(self, url: str) -> dict[str, float]:
        """Distinct terms between boundaries, with their weights."""
        out: dict[str, float] = {}
        if not len(self.terms):
            return out
        low = url.lower()
        for end, (term, weight) in self.terms.iter(low):
            start = end - len(term) + 1
            if (start == 0 or not low[start - 1].isalnum()) and (end + 1 == len(low) or not low[end + 1].isalnum()):
                out[term] = weight
        return out

    def judge(self, url: str | None) -> tuple[str, str, str | None, str, list[str]]:
        host, path = host_and_path(url)
        rule = self.rule(host, path)
        hits = self.hits(url or "")
        verdict = rule[1] if rule else "block" if sum(hits.values()) >= self.limit else "allow"
        return host, path, rule[0] if rule else None, verdict, sorted(hits)


def judge_urls(pages: DataFrame, rules: Sequence[tuple[str, str]] = RULES, strict: Sequence[str] = STRICT,
               soft: Mapping[str, float] | None = None, limit: float = SOFT_LIMIT, id_col: str = "page_id",
               url_col: str = "url") -> DataFrame:
    """Per row: ``page_id``, ``host``, ``path``, ``rule`` (the one that
    decided, else null), ``verdict`` (``allow`` or ``block``) and ``terms``
    (distinct vocabulary hits, comma-joined in order).

    A null or empty URL has empty host and path and is allowed, unless a rule
    with an empty host fits. A null id stays null, repeated rows each give a
    row, other columns are not read, and URLs of any length are read whole.
    """
    soft = dict(SOFT if soft is None else soft)
    rules, strict = tuple(rules), tuple(strict)
    names = ("host", "path", "rule", "verdict", "terms")
    schema = StructType([StructField("page_id", pages.schema[id_col].dataType)]
                        + [StructField(n, StringType(), n == "rule") for n in names])
    read = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = UrlJudge(rules, strict, soft, limit)
        for b in batches:
            rows = [judge.judge(u.as_py()) for u in b.column("url")]
            cols = list(zip(*((h, p, r, v, ",".join(t)) for h, p, r, v, t in rows))) or [()] * 5
            yield pa.RecordBatch.from_arrays([b.column("page_id"), *(pa.array(c, pa.string()) for c in cols)],
                                             names=["page_id", *names])

    return read.mapInArrow(run, schema)
