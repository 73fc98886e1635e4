"""Personal data: high-recall generators, boosted trees over format and context, calibrated thresholds.

Base generators are exact: e-mail addresses, IPv4 addresses, card numbers and phone numbers by fixed
patterns and checks; what they find always stays. Further generators propose spans that overlap freely:
addresses with spelt-out signs or letters beyond ASCII, defanged and IPv6 addresses, cards with unusual
separators, phone numbers without a plus, cards and phone numbers that other digits follow. Trees score each proposal by its format (length, digits, groups,
separators, check digit) and context (words and characters around it); a threshold for each kind, calibrated
on rows kept from the fit for PRECISION, selects. Proposals that overlap a base span are dropped, but those of its kind that hold all of it.

The trees are fitted on synthetic sentences, SENTENCES of them, made from a seed. Features come from the same
column expressions in the fit and in use, and the trees become column expressions too, so no Python runs on
the executors.

Nulls: a null text is empty. Positions are code points, ends exclusive. Repeated rows are kept, empty tables
give empty results, columns other than `base` and `spans` pass through. Texts without digits or `@` cost a scan for those alone.
"""

from __future__ import annotations

import random

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trackloom.llm import boost
from trackloom.llm.common import let, literal_table, text_of

KINDS = ("email", "ip", "card", "phone")
SENTENCES = 3000
PRECISION = 0.98
#: Matches that one step of a running sum copies at most.
GROUP = 256

#: Possessive forms of the base patterns. A match begins where a run of its characters begins, or where the
#: last match ended; so each character is read a bounded number of times.
_local = "A-Za-z0-9._%+-"
BASE = {
    "email": rf"(?:\G|(?<![{_local}]))[{_local}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_octet = "0*(?:[0-9]{1,2}|1[0-9][0-9]|2[0-4][0-9]|25[0-5])"
_at, _dot = r"(?:\x20?[(\[{]\x20?(?:at|AT|@)\x20?[)\]}]\x20?|\x20(?:at|AT)\x20)", r"(?:\x20?[(\[{]\x20?(?:dot|DOT|\.)\x20?[)\]}]\x20?|\x20(?:dot|DOT)\x20|\.)"
#: (kind, pattern) of the further generators.
MORE = (
    ("email", rf"(?<![\w.%+-])[\w.%+-]{{1,64}}{_at}[\w-]{{1,63}}(?:{_dot}[\w-]{{1,63}}){{1,4}}"),
    ("email", r"(?<![\p{L}\p{N}._%+'-])[\p{L}\p{N}._%+'-]{1,64}@[\p{L}\p{N}.-]{1,63}\.\p{L}{2,24}"),
    ("ip", r"(?<![0-9A-Za-z])[0-9]{1,3}(?:\[\.\]|\(\.\)|\x20\.\x20)[0-9]{1,3}(?:\[\.\]|\(\.\)|\x20\.\x20|\.)[0-9]{1,3}(?:\[\.\]|\(\.\)|\x20\.\x20|\.)[0-9]{1,3}(?![0-9A-Za-z])"),
    ("ip", r"(?<![0-9A-Za-z:.])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Za-z:])"),
    ("card", r"(?<![0-9A-Za-z])[0-9]{4}(?:[._/\x20-]{1,2}[0-9]{3,6}){2,4}(?![0-9A-Za-z])"),
    ("card", r"(?<![0-9A-Za-z])(?:[0-9]{4}[\x20-]?){3}[0-9]{4}(?![0-9A-Za-z])"),
    ("phone", r"(?<![0-9A-Za-z+.,-])\(?[0-9]{2,5}\)?(?:[\x20./-]{1,2}\(?[0-9]{2,5}\)?){1,5}(?![0-9A-Za-z])"),
    ("phone", r"\+[0-9]{1,3}[\x20.-]?\(?[0-9]{2,4}\)?(?:[\x20.-]?[0-9]{2,4}){2}(?![0-9])"),
)
#: Cheap tests that a text must pass before a generator reads it; whatever the generator finds passes them.
GATES = {"@": r"@", "digit": r"[0-9]", "plus": r"\+[0-9]", "spelt": rf"{_at}[\w-]{{1,63}}{_dot}[\w-]"}
#: Words that announce a kind, and words that announce other numbers.
CUES = {
    "email": "mail|e-mail|email|contact|write|correo|courriel",
    "ip": "ip|host|server|address|addr|login from",
    "card": "card|visa|mastercard|amex|credit|karte|tarjeta|carte",
    "phone": "tel|phone|call|fax|mobile|cell|telefon|tél|teléfono|ring|dial",
    "other": "isbn|order|no|nr|id|version|token|sha|date|on|since|page|pp|section|lot|serial|invoice|total|sum",
}


def matches(text: Column, pattern: str) -> Column:
    """array<struct<start, end, value, before, after>> of a pattern's matches; contexts reach to the next match."""
    hits, gaps = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, pattern, -1)
    empty = F.expr("cast(array() as array<struct<start:int,end:int,value:string,before:string,after:string>>)")

    def placed(found: Column) -> Column:
        hits, gaps = found["hits"], found["gaps"]
        pairs = F.transform(hits, lambda h, i: F.struct(h.alias("value"), F.char_length(F.get(gaps, i)).alias("skip"), F.char_length(h).alias("long"), F.right(F.get(gaps, i), F.lit(24)).alias("before"), F.left(F.get(gaps, i + 1), F.lit(4)).alias("after")))
        groups = F.transform(F.sequence(F.lit(0), F.floor((F.size(hits) - 1) / GROUP).cast("int")), lambda g: F.slice(pairs, g * GROUP + 1, GROUP))
        return let(groups, within)

    def within(groups: Column) -> Column:
        longs = F.transform(groups, lambda g: F.aggregate(g, F.lit(0), lambda acc, p: acc + p["skip"] + p["long"]))
        starts = F.aggregate(longs, F.array(F.lit(0)), lambda acc, n: F.concat(acc, F.array(F.element_at(acc, -1) + n)))
        return let(starts, lambda starts: F.flatten(F.transform(groups, lambda g, i: run(g, F.get(starts, i)))))

    def run(group: Column, start: Column) -> Column:
        first = F.struct(start.alias("at"), empty.alias("out"))
        step = lambda acc, p: F.struct((acc["at"] + p["skip"] + p["long"]).alias("at"), F.concat(acc["out"], F.array(F.struct((acc["at"] + p["skip"]).alias("start"), (acc["at"] + p["skip"] + p["long"]).alias("end"), p["value"], p["before"], p["after"]))).alias("out"))
        return F.aggregate(group, first, step, lambda acc: acc["out"])

    return let(F.struct(hits.alias("hits"), gaps.alias("gaps")), lambda f: F.when(F.size(f["hits"]) > 0, placed(f)).otherwise(empty))


def passes(kind: str, value: Column) -> Column:
    """The check of a base match."""
    digits = F.regexp_replace(value, "[^0-9]", "")
    return {
        "email": F.lit(True),
        "ip": F.regexp_like(value, F.lit(rf"^{_octet}(?:\.{_octet}){{3}}$")),
        "card": F.char_length(digits).between(12, 19) & F.call_function("luhn_check", digits),
        "phone": F.char_length(digits).between(9, 15),
    }[kind]


def candidates(text: Column) -> tuple[Column, Column]:
    """Base spans, array<struct<start, kind, end>>, and proposals with value and contexts."""
    gate = {k: F.regexp_like(text, F.lit(p)) for k, p in GATES.items()}
    gates = {"email": gate["@"], "ip": gate["digit"], "card": gate["digit"], "phone": gate["plus"]}
    none = F.expr("cast(array() as array<struct<start:int,kind:int,end:int>>)")
    wide = F.expr("cast(array() as array<struct<start:int,kind:int,end:int,value:string,before:string,after:string>>)")

    def checked(kind: str) -> Column:
        fine = F.filter(matches(text, BASE[kind]), lambda m: passes(kind, m["value"]))
        return F.when(gates[kind], F.transform(fine, lambda m: F.struct(m["start"], F.lit(KINDS.index(kind)).alias("kind"), m["end"]))).otherwise(none)

    def proposed(kind: str, pattern: str, gate: Column) -> Column:
        named = F.transform(matches(text, pattern), lambda m: F.struct(m["start"], F.lit(KINDS.index(kind)).alias("kind"), m["end"], m["value"], m["before"], m["after"]))
        return F.when(gate, named).otherwise(wide)

    ways = (gate["spelt"], gate["@"], gate["digit"], gate["digit"], gate["digit"], gate["digit"], gate["digit"], gate["plus"])
    base = F.concat(*map(checked, KINDS))
    more = F.concat(*(proposed(k, p, g) for g, (k, p) in zip(ways, MORE, strict=True)))
    return base, more


def features(c: Column) -> list[Column]:
    """Format and context of a proposal, as numbers."""
    v, before, after = c["value"], F.lower(c["before"]), c["after"]
    count = lambda pattern: F.char_length(F.regexp_replace(v, f"[^{pattern}]", ""))
    flag = lambda x: F.when(x, 1).otherwise(0)
    like = lambda col, p: flag(F.regexp_like(col, F.lit(p)))
    digits = F.regexp_replace(v, "[^0-9]", "")
    return [
        c["kind"], F.char_length(v), F.char_length(digits), count("A-Za-z"), count("().\\x20/:_-"),
        F.size(F.split(v, "[^0-9]+")), flag(F.char_length(digits).between(12, 19) & F.call_function("luhn_check", digits)), like(v, r"^[(]?0"), like(v, r"^[(]"), like(v, r"^\+"),
        like(v, r"[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{1,2}[./][0-9]{1,2}[./][0-9]{2,4}"), like(v, r"\.[A-Za-z]{2,6}$"), like(v, r"@|[(\[{]\x20?(at|AT)"), like(v, r"[:/_]"),
        like(before, r"[0-9a-z]$"), flag(F.regexp_like(after, F.lit("^[0-9A-Za-z]"))),
        *(like(before, rf"(?:^|[^a-zé])(?:{words})[^a-z0-9]{{0,6}}(?:is|ist|est|es|me at|us at|at)?[^a-z0-9]{{0,3}}$") for words in CUES.values()),
        like(before, r"[\"'=#$€]\x20?$"), like(v, r"^[0-9]{3}[\x20.-][0-9]{3}[\x20.-][0-9]{4}$|^\([0-9]{3}\)\x20?[0-9]{3}[\x20.-][0-9]{4}$"),
    ]


def sentences(seed: int = 7, n: int = SENTENCES) -> list[dict]:
    """Synthetic sentences with the spans (kind, start, end) that are personal data."""
    rng = random.Random(seed)
    digits = lambda k: "".join(rng.choice("0123456789") for _ in range(k))
    word = lambda a=3, b=9: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(a, b)))
    host = lambda: f"{word()}.{rng.choice(['com', 'org', 'net', 'de', 'example.com', 'co.uk'])}"

    def card(sep: str) -> str:
        d = [int(x) for x in rng.choice("3456") + digits(14)]
        odd = sum(x * 2 - 9 * (x > 4) for x in d[::-2]) + sum(d[-2::-2])
        d = "".join(map(str, d)) + str(-odd % 10)
        return sep.join(d[i : i + 4] for i in range(0, 16, 4))

    def spelt() -> str:
        at, dot = rng.choice([(" at ", " dot "), (" (at) ", " (dot) "), ("[at]", "[dot]"), ("(at)", "."), (" [at] ", " [dot] ")])
        return f"{word()}{at}{host().replace('.', dot)}"

    def phone() -> str:
        s = rng.choice([" ", "-", "."])
        return rng.choice([f"({digits(3)}) {digits(3)}-{digits(4)}", f"{digits(3)}{s}{digits(3)}{s}{digits(4)}", f"0{digits(2)}{s}{digits(4)}{s}{digits(4)}", f"0{digits(3)} {digits(6)}"])

    good = {
        "email": lambda: rng.choice([spelt, lambda: f"{word()}é{word(1, 4)}@{host()}", lambda: f"{word()}@{word()}ü.{rng.choice(['de', 'com'])}"])(),
        "ip": lambda: "".join(str(rng.randint(1, 255)) + (rng.choice(["[.]", "(.)", "[.]", "."]) if k else "[.]") * (k < 3) for k in range(4)) if rng.random() < 0.6 else ":".join(f"{rng.randrange(65536):x}" for _ in range(8)),
        "card": lambda: card(rng.choice([".", "_", "  ", "/", "--", "", " ", "-"])),
        "phone": lambda: phone() if rng.random() < 0.6 else f"+{digits(rng.randint(1, 2))} ({digits(3)}) {digits(3)}-{digits(4)}",
    }
    cues = {k: [c for c in v.split("|")] for k, v in CUES.items()}
    bad = [
        lambda: f"{rng.randint(1900, 2099)}-{rng.randint(1, 12):02}-{rng.randint(1, 28):02}", lambda: f"{rng.randint(1, 28)}.{rng.randint(1, 12)}.{rng.randint(1990, 2030)}",
        lambda: f"{digits(3)}-{digits(10)}", lambda: f"{digits(2)} {digits(3)}", lambda: rng.choice([".", " ", "", "-"]).join(digits(4) for _ in range(4)), lambda: f"{digits(3)} {digits(3)} {digits(3)}", lambda: f"{digits(2)}.{digits(2)}",
        lambda: f"{word()} at {word()}.{word()}", lambda: f"{word()} at {word()} dot {word()}", lambda: f"@{word()}@{word()}", lambda: f"{word()}.{word()}@{word()}", lambda: f"{digits(4)}-{digits(4)}", lambda: f"{digits(4)}/{digits(4)}/{digits(4)}", lambda: digits(rng.randint(5, 18)), lambda: f"{digits(5)}-{digits(4)}", lambda: ":".join(digits(2) for _ in range(8)),
    ]
    out = []
    for _ in range(n):
        parts, spans, at = [], [], 0

        def say(s: str) -> None:
            nonlocal at
            parts.append(s)
            at += len(s)

        say(" ".join(word() for _ in range(rng.randint(1, 5))) + rng.choice([" ", " ", ": ", ", ", "\n"]))
        for _ in range(rng.randint(1, 3)):
            if rng.random() < 0.5:
                kind = rng.choice(KINDS)
                cued = rng.random() < (0.9 if kind == "phone" else 0.4)
                if cued:
                    say(rng.choice(cues[kind]) + rng.choice([": ", " ", ". ", " is ", " = "]))
                value = good[kind]()
                # digits that merely look like a phone number are none unless something says so
                if kind != "phone" or cued or value[0] == "+":
                    spans.append({"kind": KINDS.index(kind), "start": at, "end": at + len(value)})
                say(value)
                if rng.random() < 0.2:  # other digits behind it, which the base patterns run into
                    say(f" {digits(rng.randint(2, 12))}")
            else:
                if rng.random() < 0.4:
                    say(rng.choice(cues["other"]) + rng.choice([": ", " ", " = "]))
                say(rng.choice(bad)())
            say(rng.choice([" ", ", ", ". ", "\n"]) + " ".join(word() for _ in range(rng.randint(1, 4))) + " ")
        out.append({"id": len(out), "text": "".join(parts), "truth": spans})
    return out


_models: dict = {}


def model(spark: SparkSession, seed: int = 7, precision: float = PRECISION) -> tuple[boost.Boosted, list[float]]:
    """The trees and each kind's threshold, fitted once a process."""
    if (seed, precision) not in _models:
        made = literal_table(spark, sentences(seed), "id:int,text:string,truth:array<struct<kind:int,start:int,end:int>>")
        proposed = made.select("id", "truth", F.explode(candidates(F.col("text"))[1]).alias("c"))
        same = F.exists("truth", lambda t: (t["kind"] == F.col("c.kind")) & (F.least(t["end"], F.col("c.end")) - F.greatest(t["start"], F.col("c.start")) >= 0.8 * (F.greatest(t["end"], F.col("c.end")) - F.least(t["start"], F.col("c.start")))))
        rows = proposed.select("id", same.cast("int").alias("y"), F.array(*(f.cast("double") for f in features(F.col("c")))).alias("x")).orderBy("id", "x", "y").collect()
        ids, y, x = np.array([r["id"] for r in rows]), np.array([float(r["y"]) for r in rows]), np.array([r["x"] for r in rows])
        kept = ids % 3 == 0  # sentences for the thresholds
        trees = boost.fit(x[~kept], y[~kept])
        margin = trees.margin(x)
        _models[seed, precision] = trees, [boost.threshold(margin[kept & (x[:, 0] == k)], y[kept & (x[:, 0] == k)], precision) for k in range(len(KINDS))]
    return _models[seed, precision]


def with_spans(docs: DataFrame, text: str = "text") -> DataFrame:
    """`docs` with `base` and `spans`, arrays of (start, kind, end) in order; kind is a place in KINDS. Columns of these names are replaced."""
    trees, least = model(docs.sparkSession)
    base, more = candidates(F.col("_text"))
    found = docs.withColumn("_text", text_of(text)).withColumn("base", F.array_sort(base)).withColumn("_more", more)
    limits = F.array(*(F.lit(x) for x in least))
    chosen = F.filter("_more", lambda c: trees.column(features(c)) >= F.get(limits, c["kind"]))
    within = lambda b, c: (b["kind"] == c["kind"]) & (c["start"] <= b["start"]) & (b["end"] <= c["end"])
    free = F.filter(chosen, lambda c: ~F.exists("base", lambda b: (b["start"] < c["end"]) & (c["start"] < b["end"]) & ~within(b, c)))
    spans = F.array_sort(F.array_distinct(F.concat("base", F.transform(free, lambda c: F.struct(c["start"], c["kind"], c["end"])))))
    return found.withColumn("spans", F.when(F.size("_more") > 0, spans).otherwise(F.col("base"))).drop("_more", "_text")


def listed(spans: str) -> Column:
    """kind:start:end, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def redact(found: DataFrame, text: str = "text") -> DataFrame:
    """The result of with_spans() with each span in `text` replaced by its kind in brackets; overlapping ones by the first's."""
    kind = F.array(*(F.lit(f"[{k.upper()}]") for k in KINDS))
    first = F.expr("cast(array() as array<struct<start:int,kind:int,end:int>>)")
    join = lambda acc, s: F.when((F.size(acc) > 0) & (s["start"] < F.coalesce(F.element_at(acc, -1)["end"], F.lit(0))), F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(F.struct(F.element_at(acc, -1)["start"], F.element_at(acc, -1)["kind"], F.greatest(F.element_at(acc, -1)["end"], s["end"]).alias("end"))))).otherwise(F.concat(acc, F.array(s)))
    merged = F.aggregate("spans", first, join)
    t = F.col(text)
    parts = lambda m: F.transform(m, lambda s, i: F.concat(F.substring(t, F.coalesce(F.get(m, i - 1)["end"], F.lit(0)) + 1, s["start"] - F.coalesce(F.get(m, i - 1)["end"], F.lit(0))), F.get(kind, s["kind"])))
    redacted = let(merged, lambda m: F.concat(F.array_join(parts(m), ""), F.substring(t, F.element_at(m, -1)["end"] + 1, F.char_length(t))))
    return found.withColumn(text, F.when(F.size("spans") > 0, redacted).otherwise(t))
