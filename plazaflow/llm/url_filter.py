"""Host reputation: labelled page outcomes, shrunk from host to registered domain to suffix.

The bad rate of a suffix is shrunk towards the rate of all pages, that of a registered domain
towards its suffix, that of a host towards its domain, each by a beta-binomial prior whose
strength is fitted by moments to the spread of the level below. A page is blocked when the
lower bound of its host's posterior bad rate is above a limit; explicit rules come first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# Rules as host and path, with their verdicts.
RULES = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"))
#: Suffixes of more than one label under which names are registered; else the last label is the suffix.
SUFFIXES = ("example.com", "example.net", "example.org")
# Common ones of real urls, by their last label: second levels of countries, then hosts of other people's sites.
_SECOND_LEVELS = {
    "ae": "ac co gov mil net org sch", "ar": "com edu gob gov int mil net org tur", "at": "ac co gv or", "au": "asn com edu gov id net org",
    "bd": "ac com edu gov net org", "bh": "com edu gov net org", "bo": "com edu gob net org",
    "br": "adv art blog com eco edu eng gov ind inf jus leg mil net org tv", "cn": "ac com edu gov mil net org", "co": "com edu gov mil net nom org",
    "cr": "ac co ed fi go or", "cy": "ac com gov net org", "do": "com edu gob gov net org", "ec": "com edu fin gob gov info med net org",
    "eg": "com edu eun gov net org sci", "fj": "ac com gov net org", "gh": "com edu gov org", "gr": "com edu gov net org", "gt": "com edu gob net org",
    "hk": "com edu gov idv net org", "hu": "co info org", "id": "ac co desa go mil my net or sch web", "il": "ac co gov idf k12 muni net org",
    "in": "ac co edu firm gen gov ind mil net nic org res", "ir": "ac co gov id net org sch", "jp": "ac ad co ed go gr lg ne or",
    "ke": "ac co go info me ne or sc", "kr": "ac co es go hs kg mil ms ne or pe re sc", "kw": "com edu gov net org", "lb": "com edu gov net org",
    "lk": "ac com edu gov net org sch", "ma": "ac co gov net org press", "mt": "com edu net org", "mx": "com edu gob net org",
    "my": "com edu gov mil name net org", "mz": "ac co gov net org", "ng": "com edu gov mil mobi name net org sch", "ni": "ac co com edu gob net org",
    "np": "com edu gov net org", "nz": "ac co cri geek gen govt health iwi kiwi maori mil net org parliament school", "om": "co com edu gov net org",
    "pa": "ac com edu gob net org", "pe": "com edu gob mil net nom org", "ph": "com edu gov mil net ngo org", "pk": "com edu fam gob gov net org web",
    "pl": "com edu gov info net org waw", "pr": "com edu gov net org", "pt": "com edu gov net org", "py": "com coop edu gov mil net org",
    "qa": "com edu gov net org sch", "ro": "com info org store www", "rs": "ac co edu gov in org", "sa": "com edu gov med net org pub sch",
    "sg": "com edu gov net org per", "sv": "com edu gob org red", "th": "ac co go in mi net or", "tn": "com gov ind info net org",
    "tr": "av bel bbs biz com dr edu gen gov info k12 mil name net org pol tel tv web", "tw": "club com ebiz edu game gov idv mil net org",
    "tz": "ac co go me mil ne or sc", "ua": "com edu gov in kiev kyiv lviv net odesa org", "ug": "ac co com go ne or org sc",
    "uk": "ac co gov ltd me net nhs org plc police sch", "uy": "com edu gub mil net org", "uz": "co com net org", "ve": "co com edu gob gov info net org web",
    "vn": "ac com edu gov info name net org pro", "za": "ac co edu gov law mil net nom org school web", "zm": "ac co com edu gov net org", "zw": "ac co gov mil org",
    "app": "netlify vercel web", "com": "appspot blogspot firebaseapp herokuapp", "dev": "pages workers", "io": "github gitlab", "net": "azurewebsites cloudfront",
}
PUBLIC_SUFFIXES = tuple(f"{label}.{last}" for last, labels in _SECOND_LEVELS.items() for label in labels.split())


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty without `://` or url."""
    rest = F.when(F.instr(url, "://") > 0, F.expr("substring(url, instr(url, '://') + 3)")).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"\A([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return host, F.regexp_extract(rest, r"\A[^/?#]*([^?#]*)", 1)


def longest_rule(rules: tuple[tuple[str, str], ...] = RULES) -> Column:
    """The longest rule whose host is the url's host or above it and whose path starts the url's path."""
    cases = F.lit(None).cast("string")
    for rule, _ in sorted(rules, key=lambda r: len(r[0])):
        host, slash, tail = rule.partition("/")
        fits = ((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col("path").startswith(slash + tail)
        cases = F.when(fits, F.lit(rule)).otherwise(cases)
    return cases


def with_levels(df: DataFrame, suffixes: tuple[str, ...] = SUFFIXES + PUBLIC_SUFFIXES) -> DataFrame:
    """Adds suffix and registered domain of the host (the host itself where it has no more labels)."""
    known = "|".join(s.replace(".", r"\.") for s in suffixes)
    suffix = F.regexp_extract("host", rf"(?:^|\.)({known}|[^.]+)$", 1) if known else F.regexp_extract("host", r"([^.]+)$", 1)
    domain = F.expr("CASE WHEN length(host) <= length(suffix) THEN host ELSE concat(substring_index(left(host, length(host) - length(suffix) - 1), '.', -1), '.', suffix) END")
    return df.withColumn("suffix", suffix).withColumn("domain", domain)


def _strength(groups: DataFrame, least: float = 1.0, most: float = 1000.0) -> DataFrame:
    """One row: how many pages a prior is worth, by moments over the groups' (n, bad, prior mean m).

    E[(bad - n m)^2] = n m (1-m) (1 + (n-1) rho), and a beta of strength s has rho = 1 / (s + 1).
    """
    v = F.col("n") * F.col("m") * (1 - F.col("m"))
    over = F.try_divide(F.sum(F.pow(F.col("bad") - F.col("n") * F.col("m"), 2) - v), F.sum(v * (F.col("n") - 1)))
    rho = F.greatest(F.coalesce(over, F.lit(0.0)), F.lit(1e-9))
    return groups.agg(F.least(F.greatest(1 / rho - 1, F.lit(least)), F.lit(most)).alias("s"))


def _shrunk(groups: DataFrame) -> DataFrame:
    """Posterior a, b and mean p of each group, from its counts and its prior mean."""
    both = groups.crossJoin(F.broadcast(_strength(groups)))  # one row
    both = both.withColumn("a", F.col("bad") + F.col("s") * F.col("m")).withColumn("b", F.col("n") - F.col("bad") + F.col("s") * (1 - F.col("m")))
    return both.withColumn("p", F.col("a") / (F.col("a") + F.col("b")))


def reputation(outcomes: DataFrame, z: float = 1.645) -> DataFrame:
    """Per host: n, bad, posterior mean p and its lower bound, from (host, domain, suffix, bad 0/1).

    Hosts are all those in `outcomes`; rows with a null outcome only make their host known.
    """
    n, bad = F.count("bad").alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).cast("double").alias("bad")
    hosts = outcomes.groupBy("host", "domain", "suffix").agg(n, bad)
    sums = [F.sum("n").alias("n"), F.sum("bad").alias("bad")]
    domains = hosts.groupBy("domain", "suffix").agg(*sums)
    suffixes = domains.groupBy("suffix").agg(*sums)
    mean = suffixes.agg(((F.coalesce(F.sum("bad"), F.lit(0.0)) + 0.5) / (F.coalesce(F.sum("n"), F.lit(0)) + 1)).alias("m"))  # one row
    suffixes = _shrunk(suffixes.crossJoin(F.broadcast(mean))).select("suffix", F.col("p").alias("m"))
    domains = _shrunk(domains.join(suffixes, "suffix")).select("domain", "suffix", F.col("p").alias("m"))
    hosts = _shrunk(hosts.join(domains, ["domain", "suffix"]))
    spread = F.sqrt(F.col("a") * F.col("b") / (F.pow(F.col("a") + F.col("b"), 2) * (F.col("a") + F.col("b") + 1)))
    return hosts.select("host", "n", "bad", "p", (F.col("p") - z * spread).alias("low"))


def judge_urls(pages: DataFrame, labels: DataFrame, rules: tuple[tuple[str, str], ...] = RULES,
               suffixes: tuple[str, ...] = SUFFIXES + PUBLIC_SUFFIXES, limit: float = 0.25, z: float = 1.645) -> DataFrame:
    """Verdict of each page: the longest fitting rule's, else block where the host's bound is above `limit`.

    pages: page_id, url; labels: doc_id, quality, toxic. A page's outcome is bad when the document
    that the last number of its path names is labelled low in quality or toxic; several labels of
    a document count as bad if any is, a null label as not bad. Null and malformed urls have an
    empty host, which is a host like any other. Rows may repeat; other columns are ignored.
    """
    host, path = split_url(F.col("url"))
    rows = with_levels(pages.select("page_id", host.alias("host"), path.alias("path")), suffixes)
    number = F.regexp_extract("path", r"/([0-9]{1,18})(?:[./][^0-9]*)?$", 1)
    rows = rows.withColumn("doc_id", F.when(number != "", number.cast("long"))).withColumn("rule", longest_rule(rules))
    known = labels.where("doc_id >= 0").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max(F.when((F.col("toxic") == 1) | (F.col("quality") == 0), 1).otherwise(0)).alias("bad"))
    # pages that name no document are spread over keys that no label has
    nobody = -1 - F.pmod(F.xxhash64("host", "path"), F.lit(2**20))
    outcomes = rows.select("host", "domain", "suffix", F.coalesce("doc_id", nobody).alias("doc_id")).join(known, "doc_id", "left")
    hosts = reputation(outcomes, z)
    verdict = F.lit(None).cast("string")
    for rule, said in rules:
        verdict = F.when(F.col("rule") == rule, F.lit(said)).otherwise(verdict)
    return rows.join(hosts, "host", "left").select(
        "page_id", "host", "path", "rule", F.coalesce(verdict, F.when(F.col("low") > limit, "block").otherwise("allow")).alias("verdict"), "n", "p", "low")
