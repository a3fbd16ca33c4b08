"""PII in texts and columns, and discovery over documents and vectors."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.functions import redaction
from tidemark.operators import pii, pivots, retrieval
from tidemark.session import scratch_path
from tidemark.sources import catalog
from workload.fixtures import (
    CLEAN_CONTACT_TEXT,
    CONTACT_FINDINGS,
    CONTACT_TEXT,
    contact_text,
    duck,
    fixture,
    on_contacts,
    on_payments,
    payments,
    table,
)

# Every text of the given tables that may carry personal data.
ALL_TEXTS = f"""
  SELECT 'contact' AS origin, '-' AS lang, CAST(id AS BIGINT) AS id, text FROM ({CONTACT_TEXT}) c
  UNION ALL SELECT 'documents', lang, doc_id, text FROM $documents
  UNION ALL SELECT 'conversations', role, conv_id * 100000 + turn, text FROM $conversations"""

# One request per customer; the wording depends on the market segment.
REQUESTS = """
  SELECT concat('segment ', c_mktsegment) AS question_set,
         concat(CASE c_mktsegment WHEN 'BUILDING' THEN 'Show the phone numbers of'
                                  WHEN 'MACHINERY' THEN 'How many payments were made by'
                                  WHEN 'FURNITURE' THEN 'Give me the Full Names and VPAs of'
                                  WHEN 'HOUSEHOLD' THEN 'Total amount for [PHONE] and'
                                  ELSE 'What is the UPI reference number of' END, ' ', c_name) AS text
  FROM $customer
  UNION ALL SELECT concat('conversations ', role), text FROM $conversations"""

PART_TEXT = """
  SELECT p_partkey AS id, concat('payment for ', upper(p_name), ' today by user', CAST(p_partkey AS VARCHAR(20)),
                                 '@upi') AS text FROM $part"""

# A catalog in which brands are tables and part names are columns; some columns are tagged.
PART_CATALOG = """
  SELECT DISTINCT p_brand AS table_key, 'table' AS kind, concat('Parts of ', p_brand, '. Synthetic.') AS table_description,
         concat(replace(p_name, ' ', '_'), '_', CAST(p_size AS VARCHAR(10))) AS column_name,
         concat('size ', CAST(p_size AS VARCHAR(10))) AS description, p_size % 7 = 0 AS pii
  FROM $part"""

KEYWORDS = "The in the"
N_DOCS, K_GROUPS = 40, 3


def dealt_texts(spark, sf_dir):
    """The texts over all tasks: stored customers are few bytes a row, and one task would search the texts of millions."""
    return pii.spread(fixture(spark, sf_dir, ALL_TEXTS))


def redact_text(spark, sf_dir):
    texts = dealt_texts(spark, sf_dir)
    return pii.redact_text(texts, "text").select("origin", "id", "text", F.array_join("findings", ",").alias("findings"))


def redact_known_names(spark, sf_dir):
    texts = fixture(spark, sf_dir, PART_TEXT)
    names = table(spark, sf_dir, "part").select("p_name")
    out = pii.redact_known_names(texts, "id", "text", names, "p_name")
    return out.select("id", "text", F.array_join("findings", ",").alias("findings"))


def assert_clean(spark, sf_dir):
    """Unclean rows per origin before and after redaction; the gate itself passes the redacted texts."""
    texts = dealt_texts(spark, sf_dir)
    clean = pii.redact_text(texts, "text").select(*texts.columns)
    pii.assert_clean(clean, "text")
    stages = F.explode(F.array(F.lit("before"), F.lit("after"))).alias("stage")
    origins = fixture(spark, sf_dir, ALL_TEXTS).select("origin").distinct().select("origin", stages)
    unclean = (
        pii.unclean_rows(texts, "text")
        .withColumn("stage", F.lit("before"))
        .unionByName(pii.unclean_rows(clean, "text").withColumn("stage", F.lit("after")))
    )
    counted = unclean.groupBy("origin", "stage").agg(F.count(F.lit(1)).alias("unclean"))
    return origins.join(counted, ["origin", "stage"], "left").na.fill(0, ["unclean"])


def pii_safe_projection(spark, sf_dir):
    return catalog.pii_safe_projection(payments(spark, sf_dir).users)


def pii_leak_scan(spark, sf_dir):
    f = payments(spark, sf_dir)
    values = pii.identifiers({"users": f.users, "merchants": f.merchants, "transactions": f.transactions})
    leaks = pii.leak_scan(values, fixture(spark, sf_dir, ALL_TEXTS), "text")
    return leaks.groupBy("kind").agg(F.count(F.lit(1)).alias("leaked"), F.sum("texts").alias("texts"))


def redact_audit_log(spark, sf_dir):
    """Records with nested text, written as an audit log and read back."""
    turns = table(spark, sf_dir, "conversations").select(
        F.col("conv_id").alias("id"), F.col("role").alias("actor"), F.col("text").alias("question"), "turn"
    )
    contacts = contact_text(spark, sf_dir).select(
        "id", F.lit("user").alias("actor"), F.col("text").alias("question"), F.lit(0).cast("bigint").alias("turn")
    )
    records = turns.unionByName(contacts).withColumns(
        {
            "attempts": F.array(F.lit("none"), "question"),
            "reply": F.create_map(F.lit("body"), "question"),
            "context": F.struct(F.col("question").alias("last"), "turn"),
        }
    )
    path = scratch_path(spark, "audit-log")
    # Stored customers are few bytes a row, and one task would make and redact the texts of millions.
    spread = records.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")))
    pii.write_audit_log(spread, path)
    back = spark.read.schema(records.schema).json(path)
    return back.select(
        "id", "actor", "question", "turn", F.col("attempts")[1].alias("attempt"), F.col("reply")["body"].alias("reply"),
        F.col("context.last").alias("last"),
    )


def question_vectors(spark, sf_dir):
    """One question per label: the mean of the label's vectors."""
    parts = table(spark, sf_dir, "embeddings").select("label", F.posexplode("embedding").alias("at", "x"))
    means = parts.groupBy("label", "at").agg(F.avg(F.col("x").cast("double")).alias("x"))
    return means.groupBy(F.col("label").cast("bigint").alias("query_id")).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("at", "x"))), lambda s: s["x"]).alias("embedding")
    )


def nearest(spark, sf_dir):
    docs = table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("doc_id"), F.col("label").cast("string").alias("doc_group"), "embedding"
    )
    return retrieval.vector_topk_docs(question_vectors(spark, sf_dir), docs, N_DOCS)


def every_50th(spark, sf_dir):
    """Every vector whose id is divisible by 50, as a question."""
    return table(spark, sf_dir, "embeddings").filter("vec_id % 50 = 0").select(F.col("vec_id").alias("query_id"), "embedding")


def embedded(spark, sf_dir):
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("doc_id"), F.col("label").cast("string").alias("doc_group"), "embedding"
    )


def vector_topk_pruned(spark, sf_dir):
    """The nearest vectors of every 50th, by an index that skips blocks."""
    index = pivots.build_pivot_index(embedded(spark, sf_dir))
    return pivots.pivot_topk_docs(every_50th(spark, sf_dir), index, N_DOCS)[0].withColumn("score", F.round("score", 4))


def vector_topk_groups_all(spark, sf_dir):
    nearest_ = retrieval.vector_topk_docs(every_50th(spark, sf_dir), embedded(spark, sf_dir), N_DOCS)
    return retrieval.vector_topk_groups(nearest_, K_GROUPS)


def recall_at_k_all(spark, sf_dir):
    """Does a vector find its own label among the others?"""
    found = retrieval.vector_topk_docs(every_50th(spark, sf_dir), embedded(spark, sf_dir), N_DOCS + 1)
    others = found.filter("query_id <> doc_id").withColumn(
        "rank", F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("score").desc(), "doc_id"))
    )
    ranked = retrieval.vector_topk_groups(others.filter(F.col("rank") <= N_DOCS).drop("rank"), 5)
    groups = ranked.groupBy("query_id").agg(F.sort_array(F.collect_list(F.struct("rank", "doc_group"))).alias("g"))
    own = embedded(spark, sf_dir).select(F.col("doc_id").alias("query_id"), F.array("doc_group").alias("gold"))
    return retrieval.recall_at_k(groups.join(own, "query_id").select("gold", F.col("g.doc_group").alias("retrieved")))


def vector_topk_docs(spark, sf_dir):
    return nearest(spark, sf_dir).withColumn("score", F.round("score", 4))


def vector_topk_groups(spark, sf_dir):
    return retrieval.vector_topk_groups(nearest(spark, sf_dir), K_GROUPS)


def recall_at_k(spark, sf_dir):
    """A question's gold group is its own label and, for even labels, the next one as well."""
    ranked = retrieval.vector_topk_groups(nearest(spark, sf_dir), 5)
    found = ranked.groupBy("query_id").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("rank", "doc_group"))), lambda s: s["doc_group"]).alias(
            "retrieved"
        )
    )
    own = F.col("query_id").cast("string")
    following = (F.col("query_id") + 1).cast("string")
    gold = F.when(F.col("query_id") % 2 == 0, F.array(own, following)).otherwise(F.array(own))
    return retrieval.recall_at_k(found.withColumn("gold", gold))


QUERIES = {
    "redact_text": redact_text,
    "pii_counts_by_kind": lambda spark, sf_dir: pii.counts_by_kind(
        dealt_texts(spark, sf_dir), "text", ["origin", "lang"]
    ),
    "redact_known_names": redact_known_names,
    "assert_clean": assert_clean,
    "pii_intent_flag": lambda spark, sf_dir: pii.refusal_rate(
        fixture(spark, sf_dir, REQUESTS), "text", "question_set"
    ),
    "pii_safe_projection": pii_safe_projection,
    "pii_leak_scan": pii_leak_scan,
    "redact_audit_log": redact_audit_log,
    "build_docs": lambda spark, sf_dir: retrieval.build_docs(fixture(spark, sf_dir, PART_CATALOG)),
    "vector_topk_docs": vector_topk_docs,
    "vector_topk_groups": vector_topk_groups,
    "keyword_search": lambda spark, sf_dir: retrieval.keyword_search(
        table(spark, sf_dir, "documents"), ["source", "lang", "text"], KEYWORDS
    ).select("doc_id", "source"),
    "recall_at_k": recall_at_k,
    "vector_topk_pruned": vector_topk_pruned,
    "vector_topk_groups_all": vector_topk_groups_all,
    "recall_at_k_all": recall_at_k_all,
}

# The given documents hold mail addresses, whose first part also looks like a payment address; the other
# kinds occur in the contact texts, where the result is known.
_MAIL = redaction.PATTERNS["EMAIL"]
_TEXTS = f"all_texts AS ({duck(ALL_TEXTS)})"
_KNOWN = "CASE WHEN origin = 'contact' THEN"
_INTENT = "(?i)" + redaction.INTENT_PATTERN

_BY_LABEL = """
    SELECT query_id, list(x ORDER BY pos) AS embedding FROM (
      SELECT CAST(label AS BIGINT) AS query_id, pos, avg(x) AS x FROM (
        SELECT label, unnest(range(1, 65)) AS pos, unnest(embedding::DOUBLE[]) AS x FROM embeddings) GROUP BY 1, 2)
    GROUP BY query_id"""
_EVERY_50TH = "SELECT vec_id AS query_id, embedding::DOUBLE[] AS embedding FROM embeddings WHERE vec_id % 50 = 0"


def _vectors(questions: str, but: str = "false") -> str:
    return f"""
  questions AS ({questions}),
  scored AS (
    SELECT q.query_id, e.vec_id AS doc_id, CAST(e.label AS VARCHAR) AS doc_group,
           round(list_cosine_similarity(e.embedding::DOUBLE[], q.embedding), 9) AS score
    FROM questions q CROSS JOIN embeddings e WHERE NOT ({but})),
  nearest AS (
    SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank FROM scored
    QUALIFY rank <= {N_DOCS}),
  grouped AS (
    SELECT query_id, doc_group, greatest(max(score), 0) AS best FROM nearest GROUP BY 1, 2),
  ranked AS (
    SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY best DESC, doc_group) AS INTEGER) AS rank
    FROM grouped)"""


_VECTORS = _vectors(_BY_LABEL)


def _users(column: str) -> str:
    return f"SELECT DISTINCT 'users.{column}' AS kind, {column} AS value FROM users"


ORACLES = {
    "redact_text": on_contacts(
        f"""SELECT origin, id,
              {_KNOWN} {CLEAN_CONTACT_TEXT} ELSE regexp_replace(text, '{_MAIL}', '[EMAIL]', 'g') END AS text,
              {_KNOWN} '{CONTACT_FINDINGS}'
                ELSE array_to_string(list_transform(regexp_extract_all(text, '{_MAIL}'), lambda x: 'EMAIL'), ',')
              END AS findings
            FROM all_texts""",
        _TEXTS,
    ),
    "pii_counts_by_kind": on_contacts(
        f"""SELECT origin, lang, kind, CAST(sum(
              CASE WHEN origin = 'contact' THEN CASE WHEN kind IN ('PHONE', 'EMAIL', 'VPA', 'UPI_REF') THEN 1 ELSE 0 END
                   WHEN kind = 'EMAIL' THEN len(regexp_extract_all(text, '{_MAIL}'))
                   WHEN kind = 'UPI_REF' THEN len(list_filter(regexp_extract_all(text, '[0-9]+'), lambda d: len(d) = 12))
                   ELSE 0 END) AS BIGINT) AS hits
            FROM all_texts CROSS JOIN (SELECT unnest({list(redaction.PATTERNS)}) AS kind)
            GROUP BY origin, lang, kind""",
        _TEXTS,
    ),
    "redact_known_names": f"""
        SELECT id, 'payment for [NAME] today by [VPA]' AS text, 'NAME,VPA' AS findings FROM ({duck(PART_TEXT)})""",
    "assert_clean": on_contacts(
        f"""SELECT origin, stage, count(*) FILTER (WHERE stage = 'before' AND (origin = 'contact'
                   OR regexp_matches(text, '{_MAIL}'))) AS unclean
            FROM all_texts CROSS JOIN (SELECT unnest(['before', 'after']) AS stage) GROUP BY origin, stage""",
        _TEXTS,
    ),
    "pii_intent_flag": f"""
        SELECT question_set, count(*) AS questions,
               count(*) FILTER (WHERE regexp_matches(regexp_replace(text, '\\[[A-Z_]+\\]', '', 'g'), '{_INTENT}')) AS refused
        FROM ({duck(REQUESTS)}) GROUP BY question_set""",
    "pii_safe_projection": on_payments("SELECT user_id, city, kyc_status, created_at, updated_at, dt FROM users"),
    "pii_leak_scan": on_payments(
        """SELECT i.kind, count(DISTINCT i.value) AS leaked, count(DISTINCT (i.value, c.origin, c.id)) AS texts
           FROM identifiers i JOIN candidates c ON c.run = i.value GROUP BY i.kind""",
        f"""{_TEXTS}, identifiers AS (
              {" UNION ALL ".join(_users(c) for c in ("full_name", "phone", "email", "vpa"))}
              UNION ALL SELECT DISTINCT 'merchants.contact_phone', contact_phone FROM merchants
              UNION ALL SELECT DISTINCT 'transactions.upi_ref', upi_ref FROM transactions),
            digit_runs AS (SELECT origin, id, unnest(regexp_extract_all(text, '\\+?[0-9]+')) AS run FROM all_texts),
            sides AS (SELECT DISTINCT strpos(value, '@') - 1 AS l, length(value) - strpos(value, '@') AS r
                      FROM identifiers WHERE contains(value, '@')),
            around AS (
              SELECT origin, id, parts[k] AS a, parts[k + 1] AS b
              FROM (SELECT origin, id, string_split(text, '@') AS parts, unnest(range(1, len(string_split(text, '@')))) AS k
                    FROM all_texts WHERE contains(text, '@'))),
            candidates AS (
              SELECT origin, id, left(run, 13) AS run FROM digit_runs WHERE run LIKE '+%' AND length(run) >= 13
              UNION ALL
              SELECT origin, id, substring(run, i, 12) FROM (
                SELECT origin, id, ltrim(run, '+') AS run, unnest(range(1, length(ltrim(run, '+')) - 10)) AS i FROM digit_runs)
              UNION ALL
              SELECT origin, id, right(a, l) || '@' || left(b, r) FROM around, sides WHERE length(a) >= l AND length(b) >= r
              UNION ALL
              SELECT origin, id, trim(unnest(regexp_extract_all(text, '[\\p{{L}}\\p{{N}}_@+%''.\\-]+')), '.''-') FROM all_texts)""",
    ),
    "redact_audit_log": on_contacts(
        f"""SELECT *, question AS attempt, question AS reply, question AS last FROM (
              SELECT conv_id AS id, role AS actor, regexp_replace(text, '{_MAIL}', '[EMAIL]', 'g') AS question, turn
              FROM conversations
              UNION ALL SELECT id, 'user', {CLEAN_CONTACT_TEXT}, 0 FROM contact_text)"""
    ),
    "build_docs": f"""
        WITH c AS ({duck(PART_CATALOG)})
        SELECT table_key, NULL AS column_name, kind || ' ' || table_key || ': ' || table_description || ' Columns: '
               || string_agg(DISTINCT column_name, ', ' ORDER BY column_name) AS content
        FROM c WHERE NOT pii GROUP BY table_key, kind, table_description
        UNION ALL
        SELECT table_key, column_name, 'column ' || column_name || ' of ' || table_key || ' ('
               || split_part(table_description, '.', 1) || '): ' || description
        FROM c WHERE NOT pii""",
    "vector_topk_docs": f"WITH {_VECTORS} SELECT query_id, doc_id, doc_group, round(score, 4) AS score, rank FROM nearest",
    "vector_topk_groups": f"""
        WITH {_VECTORS} SELECT query_id, doc_group, round(best, 4) AS score, rank FROM ranked WHERE rank <= {K_GROUPS}""",
    "keyword_search": """
        SELECT doc_id, source FROM documents
        WHERE contains(lower(source || ' ' || lang || ' ' || text), 'the')
          AND contains(lower(source || ' ' || lang || ' ' || text), 'in')""",
    "recall_at_k": f"""
        WITH {_VECTORS},
        gold AS (SELECT query_id, CAST(query_id AS VARCHAR) AS g FROM questions
                 UNION ALL SELECT query_id, CAST(query_id + 1 AS VARCHAR) FROM questions WHERE query_id % 2 = 0),
        matched AS (
          SELECT c.k, g.query_id, count(*) AS wanted,
                 count(*) FILTER (WHERE EXISTS (SELECT 1 FROM ranked r WHERE r.query_id = g.query_id
                                                AND r.doc_group = g.g AND r.rank <= c.k)) AS hit
          FROM gold g CROSS JOIN (SELECT CAST(unnest([1, 3, 5]) AS BIGINT) AS k) c GROUP BY 1, 2)
        SELECT k, count(*) AS questions, round(avg(hit / wanted), 3) AS recall,
               round(avg(CAST(hit = wanted AS INTEGER)), 3) AS all_gold,
               round(avg(CAST(hit > 0 AS INTEGER)), 3) AS any_gold
        FROM matched GROUP BY k""",
    "vector_topk_pruned": f"""
        WITH {_vectors(_EVERY_50TH)} SELECT query_id, doc_id, doc_group, round(score, 4) AS score, rank FROM nearest""",
    "vector_topk_groups_all": f"""
        WITH {_vectors(_EVERY_50TH)}
        SELECT query_id, doc_group, round(best, 4) AS score, rank FROM ranked WHERE rank <= {K_GROUPS}""",
    "recall_at_k_all": f"""
        WITH {_vectors(_EVERY_50TH, "q.query_id = e.vec_id")},
        placed AS (SELECT query_id, min(rank) FILTER (WHERE doc_group = CAST(label AS VARCHAR)) AS place
                   FROM ranked JOIN embeddings ON vec_id = query_id GROUP BY query_id),
        hits AS (SELECT k, CAST(coalesce(place <= k, false) AS INTEGER) AS hit
                 FROM placed CROSS JOIN (SELECT CAST(unnest([1, 3, 5]) AS BIGINT) AS k))
        SELECT k, count(*) AS questions, round(avg(hit), 3) AS recall, round(avg(hit), 3) AS all_gold,
               round(avg(hit), 3) AS any_gold FROM hits GROUP BY k""",
}
