"""URL filters: rules first, then logistic regression on hashed character n-grams of host and path.

The classifier is trained on the driver from a small labelled table (at most ``max_labelled`` rows,
else an error); its weights are one vector of fixed size. Rules fit a host and its subdomains if the
path starts with theirs; the longest rule (host and path together, then by text) wins.

Null urls and urls without ``://`` have empty host and path: no rule fits, and the verdict is allow, as
there is nothing to judge. Repeated rows get equal verdicts, an empty table an empty result. Other
columns are kept; the new ones avoid their names.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import lru_cache, partial
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from glebe.llm.tables import apart

SLOTS = 1 << 15
SIZES = (3, 4, 5)
MAX_LABELLED = 10_000

#: Labelled urls, blocked kinds first
BLOCKED = """
https://casino-royal.example.com/slots https://www.best-casino.example.net/bonus http://casino-online.example.org/en/play
https://win-casino.example.net/en/12 https://m.casino-spins.example.com/de/44 http://bets-today.example.org/en/odds
https://free-bets.example.net/en/7 https://sports-bets.example.com/live http://www.bets-free.example.org/fr/18
https://poker-win.example.com/table https://adult-cams.example.org/en/9 http://adult-videos.example.net/watch
https://www.adult-xxx.example.com/en/100 http://m.adult-dating.example.com/es/31 https://xxx-adult.example.org/de/5
https://porn-tube.example.net/video/8 https://spam-links.example.com/en/3 http://link-farm.example.org/fr/71
https://spam-farm.example.net/page/2 http://www.spam-seo.example.com/en/900 https://cheap-pills.example.org/buy
http://viagra-cheap.example.net/order https://pills-online.example.com/en/6 http://win-prizes.example.net/claim
https://free-money.example.com/now http://crypto-doubler.example.org/go https://warez-crack.example.net/dl/1
http://torrent-crack.example.com/keygen https://malware-free.example.org/setup.exe http://loan-fast.example.net/apply
""".split()
ALLOWED = """
https://www.thermal.example.com/en/12 http://blog.tionary.example.net/en/853 https://m.therapist.example.org/de/511
https://news.example.com/2020/05/01/story.html http://www.library.example.org/catalog/88 https://docs.example.net/en/intro
https://university.example.org/physics/lecture http://recipes.example.com/soup?id=4 https://weather.example.net/fr/paris
http://blog.gardening.example.com/tomatoes https://museum.example.org/es/salas/3 https://forum.example.net/topic/552
http://www.history.example.com/rome/12.html https://m.travel.example.org/de/berlin https://science.example.net/en/748
http://the-herald.example.com/en/676 https://www.thonet.example.org/en/25 https://blog.ations.example.net/en/118#top
http://thread.example.com/en/214?page=2 https://thesis.example.org/en/977 https://www.atlas.example.net/fr/10
http://m.north.example.com/en/29 https://thorium.example.org/es/797 https://stories.example.net/en/673/
http://www.hanover.example.com/de/252.html https://ering.example.org/en/80 https://blog.tiller.example.com/en/99
https://health.example.org/heart/faq http://courts.example.net/case/9 https://maps.example.com/en/region/4
https://music.example.net/fr/jazz http://www.theory.example.org/en/403.html https://ander.example.com/en/27
https://thoughts.example.com/en/12 http://www.thouble.example.org/fr/3 https://table.example.com/en/60 http://m.trouble.example.net/en/8
https://ththoria.example.com/en/81 https://outhouse.example.com/fr/365 https://blog.ionian.example.net/en/78?utm_source=feed http://thatch.example.org/de/945 https://www.erthe.example.com/en/31
""".split()

_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host after the first ``://``, A-Z lower-cased, and the path up to ``?`` or ``#``; empty where there is none."""
    url = F.coalesce(url, F.lit(""))
    part = lambda k: F.regexp_extract(url, r"(?s)\A.*?://([^/?#]*)([^?#]*)", k)
    return F.translate(part(1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), part(2)


def split_url(url: str) -> tuple[str, str]:
    rest = url.partition("://")[2]
    end = min([i for i in map(rest.find, "?#") if i >= 0], default=len(rest))
    host, slash, path = rest[:end].partition("/")
    return host.translate(_LOWER), slash + path


def grams(text: str, kind: str) -> list[int]:
    data = f"^{text}$".encode()
    seed = crc32(kind.encode())
    return [crc32(data[i : i + n], seed) % SLOTS for n in SIZES for i in range(len(data) - n + 1)]


def features(host: str, path: str) -> np.ndarray:
    """Distinct slots of the n-grams of host and path, which do not share a seed."""
    return np.unique(np.array(grams(host, "host") + grams(path, "path"), np.int64)) if host or path else np.zeros(0, np.int64)


class UrlModel:
    """Logistic regression with ridge penalty, by gradient steps over rows scaled to unit length."""

    def __init__(self, urls: Sequence[str], blocked: Sequence[int], steps: int = 400, rate: float = 2.0, ridge: float = 1e-4):
        rows = [features(*split_url(u)) for u in urls]
        self.weight, self.bias = np.zeros(SLOTS), 0.0
        y = np.array(blocked, float)
        flat = np.concatenate(rows) if rows else np.zeros(0, np.int64)
        row = np.repeat(np.arange(len(rows)), [r.size for r in rows])
        scale = np.array([1 / np.sqrt(max(1, r.size)) for r in rows])
        for _ in range(steps if rows else 0):
            z = np.bincount(row, self.weight[flat], len(rows)) * scale + self.bias
            error = 1 / (1 + np.exp(-z)) - y
            self.weight -= rate * (np.bincount(flat, (error * scale)[row], SLOTS) / len(rows) + ridge * self.weight)
            self.bias -= rate * error.mean()

    def score(self, host: str, path: str) -> float:
        at = features(host, path)
        if not at.size:
            return 0.0
        return float(1 / (1 + np.exp(-(self.weight[at].sum() / np.sqrt(at.size) + self.bias))))


def train(labelled: DataFrame, url: str = "url", blocked: str = "blocked", max_labelled: int = MAX_LABELLED) -> UrlModel:
    """Model of a small table of urls with 0/1 labels; rows with a null are left out."""
    rows = labelled.select(url, blocked).dropna().limit(max_labelled + 1).collect()
    if len(rows) > max_labelled:
        raise ValueError(f"more than {max_labelled} labelled urls")
    rows.sort()
    return UrlModel([r[0] for r in rows], [r[1] for r in rows])


class Rules:
    """(action, rule) pairs like ("block", "net/") by host, longest first."""

    def __init__(self, pairs: Sequence[tuple[str, str]]):
        self.by_host: dict[str, list[tuple[str, str, str]]] = {}
        for action, rule in pairs:
            host, slash, path = rule.partition("/")
            self.by_host.setdefault(host, []).append((slash + path, rule, action))

    def find(self, host: str, path: str) -> tuple[str, str] | tuple[None, None]:
        labels = host.split(".")
        fits = [
            (len(rule), rule, action)
            for i in range(len(labels))
            for start, rule, action in self.by_host.get(".".join(labels[i:]), ())
            if path.startswith(start)
        ]
        return max(fits)[1:] if fits else (None, None)


def _judge(batches: Iterator[pa.RecordBatch], host: str, path: str, rules: Rules, model, names: list[str]) -> Iterator[pa.RecordBatch]:
    score = lru_cache(100_000)(model.value.score)
    for batch in batches:
        out = []
        for h, p in zip(batch.column(host).to_pylist(), batch.column(path).to_pylist()):
            rule, action = rules.find(h, p)
            s = score(h, p)
            out.append((rule, action or ("block" if s > 0.5 else "allow"), s))
        rule, verdict, s = zip(*out) if out else ((), (), ())
        new = [pa.array(rule, pa.string()), pa.array(verdict, pa.string()), pa.array(s, pa.float64())]
        yield pa.RecordBatch.from_arrays([*batch.columns, *new], [*batch.schema.names, *names])


def judge(pages: DataFrame, rules: Rules, model: UrlModel, url: str = "url") -> tuple[DataFrame, list[str]]:
    """``pages`` with host, path, rule, verdict and block score; returns the names of these columns."""
    names = apart(pages, "host", "path", "rule", "verdict", "score")
    h, p = host_and_path(F.col(url))
    split = pages.withColumns({names[0]: h, names[1]: p})
    kinds = [T.StringType(), T.StringType(), T.DoubleType()]
    schema = T.StructType([*split.schema.fields, *(T.StructField(n, k) for n, k in zip(names[2:], kinds))])
    job = partial(_judge, host=names[0], path=names[1], rules=rules, model=pages.sparkSession.sparkContext.broadcast(model), names=names[2:])
    return split.mapInArrow(job, schema), names
