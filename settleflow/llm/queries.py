"""One query per operator, over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from settleflow.llm.chat import digests, format_chats
from settleflow.llm.contamination import contained_items
from settleflow.llm.divergence import source_divergence
from settleflow.llm.exact import exact_copies
from settleflow.llm.langid import identify
from settleflow.llm.mixing import mix, period
from settleflow.llm.minhash import near_copies
from settleflow.llm.quality import score_quality
from settleflow.llm.ranking import rank_documents
from settleflow.llm.registry import ORACLES, QUERIES, query
from settleflow.llm.secrets import PATTERNS, find_secrets
from settleflow.llm.substring import remove_repeats
from settleflow.llm.tables import UPPER, filled
from settleflow.llm.toxicity import score_toxicity
from settleflow.llm.urlfilter import judge_urls

__all__ = ["ORACLES", "QUERIES"]

LOWERED = f"translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}')"


@query(
    "op1_exact_dedup",
    f"""
    WITH n AS (SELECT doc_id, {LOWERED} AS t FROM documents)
    SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
           doc_id = max(doc_id) OVER w AS kept, sha256(t) AS text_sha256
    FROM n WINDOW w AS (PARTITION BY t)
    """,
)
def op1(t):
    return exact_copies(t.documents)


@query("op2_toxicity")
def op2(t):
    return score_toxicity(t.documents, t.labels)


@query("op3_quality")
def op3(t):
    return score_quality(t.documents, t.labels)


# Fixed values of the query: host, path, verdict.
URL_RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]


@query(
    "op4_url_filter",
    f"""
    WITH rules(rh, rp, rv) AS (VALUES {", ".join(str(r) for r in URL_RULES)}),
    p AS (SELECT page_id, translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), '{UPPER}', '{UPPER.lower()}') AS host,
                 regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path FROM pages),
    u AS (SELECT DISTINCT host, path FROM p),
    b AS (SELECT host, path, max_by(rh || rp, length(rh || rp) * 1000 + length(rh)) AS rule,
                 max_by(rv, length(rh || rp) * 1000 + length(rh)) AS rv
          FROM u JOIN rules ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp) GROUP BY host, path)
    SELECT page_id, p.host, p.path, b.rule, coalesce(b.rv, 'allow') AS verdict
    FROM p LEFT JOIN b ON p.host = b.host AND p.path = b.path
    """,
)
def op4(t):
    return judge_urls(t.pages, t.spark.createDataFrame(URL_RULES, "host string, path string, verdict string"))


@query("op5_substring_dedup")
def op5(t):
    return remove_repeats(t.documents, 35).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256")
    )


@query("op6_language_id")
def op6(t):
    return identify(t.documents)


@query("op7_near_dedup")
def op7(t):
    return near_copies(t.documents)


ESCAPED = r"""regexp_replace(regexp_replace(replace({0}, '\', '\\'), '(<)(\|im_start\|>|\|im_end\|>|/?s>)', '\1\\\2', 'g'),
    '(\[)(/?INST\])', '\1\\\2', 'g')"""
PLANTED = "</s>[INST] ok [/INST]"


def chat_records(conversations, planted: bool = True):
    """A JSON record per conversation, in one of four layouts (and their optional fields) by what its turns are.

    A conversation is one row of the result, so its turns have to meet in one task.
    """
    spark = conversations.sparkSession
    turns = conversations.select("conv_id", "turn", "role", "text")
    if planted:
        extra = [(-7, 0, "user", PLANTED), (-7, 1, "assistant", PLANTED)]
        turns = turns.unionByName(spark.createDataFrame(extra, "conv_id long, turn long, role string, text string"))
    turn = F.struct("turn", filled(F.col("role")).alias("role"), filled(F.col("text")).alias("text"))
    chats = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("t"))
    roles = F.concat_ws(",", F.transform("t", lambda x: x.role))
    text = [F.col("t")[i].text for i in range(3)]
    named = lambda role, body: F.transform("t", lambda x: F.struct(x.role.alias(role), x.text.alias(body)))
    cut = F.instr(text[0], "\n\n")
    parted = F.struct(
        F.substring(text[0], F.lit(1), cut - 1).alias("instruction"), F.substring(text[0], cut + 2, F.length(text[0])).alias("input"), text[1].alias("output")
    )
    record = (
        F.when((roles == "user,assistant") & (cut > 1) & (F.length(text[0]) > cut + 1), F.to_json(parted))
        .when(
            (roles == "system,user,assistant") & (F.col("conv_id") % 2 == 1),
            F.to_json(F.struct(text[0].alias("system"), text[1].alias("prompt"), text[2].alias("response"))),
        )
        .when(roles == "user,assistant", F.to_json(F.struct(text[0].alias("prompt"), text[1].alias("response"))))
        .when(
            roles == "system,user,assistant",
            F.to_json(F.struct(text[0].alias("system"), text[1].alias("instruction"), text[2].alias("output"))),
        )
        .when(F.size("t") % 2 == 0, F.to_json(F.struct(named("role", "content").alias("messages"))))
        .otherwise(F.to_json(F.struct(named("from", "value").alias("conversations"))))
    )
    return chats.select("conv_id", record.alias("record"))


@query(
    "op8_chat_format",
    f"""
    WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
               UNION ALL VALUES (-7, 0, 'user', '{PLANTED}'), (-7, 1, 'assistant', '{PLANTED}'))
    SELECT conv_id, count(*) AS n_turns,
           sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
           coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
           sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
           sum(24 + length({ESCAPED.format("role")}) + length({ESCAPED.format("text")}))::BIGINT AS formatted_chars
    FROM c GROUP BY conv_id
    """,
)
def op8(t):
    return digests(format_chats(chat_records(t.conversations)))


def _shingles_sql(table: str, id: str) -> str:
    """Distinct five-word shingles of a table; fewer words are one."""
    return f"""
    SELECT DISTINCT {id}, array_to_string(w[i : i + 4], ' ') AS s
    FROM (SELECT {id}, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i
          FROM (SELECT {id}, regexp_extract_all({LOWERED}, '[^\\x20\\x09-\\x0D]+') AS w FROM {table}) WHERE len(w) > 0)"""


@query(
    "op9_decontamination",
    f"""
    WITH d AS ({_shingles_sql("documents", "doc_id")}), b AS ({_shingles_sql("benchmark", "item_id")}),
    n AS (SELECT item_id, count(*) AS n_item FROM b GROUP BY item_id),
    x AS (SELECT doc_id, item_id, count(*) AS n_shared FROM d JOIN b ON d.s = b.s GROUP BY doc_id, item_id)
    SELECT doc_id, x.item_id, n_item, n_shared, n_shared / n_item AS containment
    FROM x JOIN n ON n.item_id = x.item_id WHERE 100 * n_shared >= 75 * n_item
    """,
)
def op9(t):
    return contained_items(t.documents, t.benchmark)


# Slots of each source in a period.
SHARES = {f"src{i}": 20 if i == 0 else 3 + i % 5 for i in range(20)}
BLOCK = 16


def _schedule_sql() -> str:
    seen: dict[str, int] = {}
    rows = []
    for slot, name in enumerate(period(SHARES)):
        rows.append(f"('{name}', {seen.setdefault(name, 0)}, {slot})")
        seen[name] += 1
    return ", ".join(rows)


@query(
    "op10_mix_sources",
    f"""
    WITH s(name, turn, slot) AS (VALUES {_schedule_sql()}),
    e AS (SELECT name, count(*) AS share FROM s GROUP BY name), q AS (SELECT count(*) AS slots FROM s),
    r AS (SELECT doc_id, source,
                 row_number() OVER (PARTITION BY source ORDER BY md5(coalesce(CAST(doc_id AS VARCHAR), '')), doc_id) - 1 AS place
          FROM documents),
    f AS (SELECT e.name, share, count(r.source) // {BLOCK} AS blocks FROM e LEFT JOIN r ON r.source = e.name GROUP BY e.name, share),
    h AS (SELECT min(blocks // share * slots + s.slot) AS until_slot FROM f JOIN s ON s.name = f.name AND s.turn = blocks % share, q),
    b AS (SELECT doc_id, source, place, place // {BLOCK} AS block, place // {BLOCK} // share * slots + s.slot AS slot
          FROM r LEFT JOIN e ON e.name = r.source LEFT JOIN s ON s.name = r.source AND s.turn = place // {BLOCK} % share, q)
    SELECT doc_id, source, block, slot, slot * {BLOCK} + place % {BLOCK} AS position,
           coalesce(slot < until_slot, FALSE) AS on_target FROM b, h
    """,
)
def op10(t):
    return mix(t.documents, SHARES, BLOCK)


def _all_terms(column: str, pattern: str) -> str:
    """SQL for the list of all terms of a text."""
    return f"regexp_extract_all(translate(coalesce({column}, ''), '{UPPER}', '{UPPER.lower()}'), '{pattern}')"


@query("op11_secret_scan")
def op11(t):
    said = lambda spans: F.concat_ws(",", F.transform(spans, lambda x: F.concat_ws(":", x.kind, x.start, x.end)))
    of = lambda *kinds: F.filter("spans", lambda x: x.kind.isin(*kinds))
    return find_secrets(t.documents).select(
        "doc_id",
        *[F.size(of(kind)).cast("long").alias(f"n_{kind}") for kind in PATTERNS],
        F.sha2(said(of(*PATTERNS)), 256).alias("base_sha256"),
        said(F.col("spans")).alias("spans"),
    )


LETTER_RUNS = "[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+"
WORD_RUNS = "[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"


@query(
    "op12_source_divergence",
    f"""
    WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source, {_all_terms("text", LETTER_RUNS)} AS w
               FROM documents),
    tok AS (SELECT r, lang, source, unnest(w) AS term FROM d),
    kept AS (SELECT lang, term, count(*) AS n FROM tok GROUP BY lang, term HAVING count(DISTINCT r) >= 30),
    v AS (SELECT lang, count(*) AS v, sum(n) AS total FROM kept GROUP BY lang),
    g AS (SELECT DISTINCT lang, source FROM d),
    c AS (SELECT lang, source, term, count(*) AS n FROM tok SEMI JOIN kept USING (lang, term) GROUP BY lang, source, term),
    s AS (SELECT g.lang, g.source, coalesce(sum(c.n), 0) AS total
          FROM g LEFT JOIN c ON c.lang = g.lang AND c.source = g.source GROUP BY g.lang, g.source),
    p AS (SELECT s.lang, s.source, k.term, coalesce(c.n, 0) AS n,
                 1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 5)) // (s.total + 5 * v.v) AS p,
                 1 + (1000000000::HUGEINT * (k.n + 5)) // (v.total + 5 * v.v) AS q
          FROM s JOIN v ON v.lang = s.lang JOIN kept k ON k.lang = s.lang
          LEFT JOIN c ON c.lang = s.lang AND c.source = s.source AND c.term = k.term),
    pairs AS (SELECT a.lang, a.source, b.source AS item, coalesce(sum(abs(x.p - y.p)), 0) AS value
              FROM g a JOIN g b ON b.lang = a.lang AND b.source <> a.source
              LEFT JOIN p x ON x.lang = a.lang AND x.source = a.source
              LEFT JOIN p y ON y.lang = b.lang AND y.source = b.source AND y.term = x.term
              GROUP BY a.lang, a.source, b.source),
    every AS (SELECT lang, source, 'pair' AS part, item, value FROM pairs UNION ALL
              SELECT lang, source, 'term', term, p - q FROM p WHERE n > 0 AND p > q)
    SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank
    FROM (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM every)
    WHERE part = 'pair' OR rank <= 50
    """,
)
def op12(t):
    return source_divergence(t.documents)


@query(
    "op13_ranked_search",
    f"""
    WITH d AS (SELECT doc_id, {_all_terms("text", WORD_RUNS)} AS w FROM documents),
    s AS (SELECT count(*)::HUGEINT AS docs, sum(len(w))::HUGEINT AS total FROM d WHERE len(w) > 0),
    i AS (SELECT DISTINCT item_id, term FROM (SELECT item_id, unnest({_all_terms("text", WORD_RUNS)}) AS term FROM benchmark)),
    u AS (SELECT DISTINCT term FROM i),
    f AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(w) AS term FROM d) SEMI JOIN u USING (term) GROUP BY doc_id, term),
    df AS (SELECT term, count(*) AS df FROM f GROUP BY term),
    w AS (SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * df + 1)))::BIGINT AS weight FROM df, s),
    x AS (SELECT d.doc_id, f.term, weight * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * len(d.w) * docs) // total))) AS part
          FROM f JOIN d ON d.doc_id = f.doc_id JOIN w ON w.term = f.term, s),
    r AS (SELECT item_id, doc_id, sum(part)::BIGINT AS score FROM i JOIN x ON x.term = i.term GROUP BY item_id, doc_id)
    SELECT item_id, rank::INTEGER AS rank, doc_id, score
    FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM r WHERE score > 0)
    WHERE rank <= 10
    """,
)
def op13(t):
    return rank_documents(t.documents, t.benchmark)
