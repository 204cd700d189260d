"""The operators as registered queries over the test tables, and their SQL twins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shopledger.llm import (
    conversations,
    embeddings,
    exact,
    fingerprints,
    language,
    mixing,
    neardup,
    packing,
    quality,
    runs,
    substrings,
    token_counts,
    toxicity,
)
from shopledger.llm.fitting import remainder
from shopledger.llm.workspace import Workspace


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def tokenizer_file() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_neardup(spark: SparkSession, folder: str) -> DataFrame:
    found = neardup.near_duplicates(_table(spark, folder, "documents"))
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def op2_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprints.edited_fingerprints(_table(spark, folder, "documents"))


def op3_embeddings(spark: SparkSession, folder: str) -> DataFrame:
    return embeddings.near_vectors(_table(spark, folder, "embeddings"))


def op4_language(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    held_out = F.coalesce(remainder("doc_id", 5) == 0, F.lit(False))
    model = language.train(docs, ~held_out)
    predicted = language.predict(docs, model, keep=["doc_id"])
    return predicted.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op5_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = _table(spark, folder, "documents"), _table(spark, folder, "labels")
    held_out = F.coalesce(remainder("doc_id", 4) == 2, F.lit(False))
    model = toxicity.train(docs, labels, ~held_out)
    return toxicity.score(docs, model, keep=["doc_id"]).select("doc_id", held_out.alias("held_out"), "score", "predicted")


def op6_mixing(spark: SparkSession, folder: str) -> DataFrame:
    mixed = mixing.mix_sources(_table(spark, folder, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "copies")


def op7_substrings(spark: SparkSession, folder: str) -> DataFrame:
    found = substrings.remove_repeats(_table(spark, folder, "documents"), keep=["doc_id"])
    return found.select("doc_id", "n_words", "n_removed", "kept_sha256")


def op8_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(_table(spark, folder, "documents"), tokenizer_file(), with_ids=False)


def op9_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = _table(spark, folder, "documents"), _table(spark, folder, "labels")
    held_out = F.coalesce(remainder("doc_id", 3) == 1, F.lit(False))
    model = quality.train(docs, labels, ~held_out)
    return quality.score(docs, model, keep=["doc_id"]).select("doc_id", held_out.alias("held_out"), "score", "predicted")


WORDS_AND_MARKS = r"[A-Za-z0-9]+|[^A-Za-z0-9\x20\x09-\x0D]"


def op10_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Totals after an insert of all documents and a batch of changes, each sent twice.

    The second batch deletes the documents whose id ends in 3 and revises those whose id ends in 7:
    their text now holds itself twice, and those of no language are of the language ``und``.
    """
    docs = _table(spark, folder, "documents").select("doc_id", "text", "source", "lang")
    versions = {"words-1": mixing.WORD, "marks-1": WORDS_AND_MARKS}
    counts = token_counts.counted(docs, versions)
    ends_in = F.pmod(F.col("doc_id"), F.lit(10))
    inserts = token_counts.changes(counts)
    gone = token_counts.changes(counts.withColumn("tokens", F.lit(0)).filter(ends_in == 3), deleted=True)
    twice = docs.filter(ends_in == 7).withColumn("text", F.concat_ws(" ", "text", "text"))
    revised = token_counts.counted(twice.withColumn("lang", F.coalesce("lang", F.lit("und"))), versions)
    ledger = token_counts.Ledger(spark, Workspace(spark, "ledger").root)
    for _ in range(2):
        ledger.commit("first", inserts)
        ledger.commit("second", gone.unionByName(token_counts.changes(revised)))
    return ledger.totals()


def with_planted_periods(docs: DataFrame) -> DataFrame:
    """``doc_id, text``, where a tenth of the texts repeat from some word on with some period."""
    h = F.crc32(F.col("doc_id").cast("string"))
    g = F.floor(h / 10)

    def repeat(w: Column) -> Column:
        n = F.size(w)
        a = (g % n).cast("int")
        p = (F.lit(1) + F.floor((n - a) / (F.lit(3) + g % 8))).cast("int")
        again = F.transform(F.sequence(a, n - 1), lambda i: F.get(w, a + (i - a) % p))
        return F.when(n > 0, F.array_join(F.concat(F.slice(w, 1, a), again), " "))

    # The words are bound as a lambda's argument, so that they are cut once for each text.
    planted = F.transform(F.array(F.regexp_extract_all("text", F.lit(mixing.WORD), 0)), repeat)[0]
    return docs.select("doc_id", F.coalesce(F.when(h % 10 == 0, planted), F.col("text")).alias("text"))


def op11_runs(spark: SparkSession, folder: str) -> DataFrame:
    found = runs.periodic_runs(with_planted_periods(_table(spark, folder, "documents")))
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("n"), (-r["start"]).alias("s"), (-r["period"]).alias("p"))))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    listed = F.when(F.size("runs") > 0, F.concat(F.array_join(lines, "\n"), F.lit("\n"))).otherwise("")
    return found.withColumn("longest", longest).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("longest.s")).alias("start"),
        F.col("longest.n").alias("length"),
        (-F.col("longest.p")).alias("period"),
        F.floor(F.lit(1000) * F.col("longest.n") / -F.col("longest.p")).cast("long").alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op12_exact(spark: SparkSession, folder: str) -> DataFrame:
    return exact.exact_duplicates(_table(spark, folder, "documents"), digests=True)


def rebuilt_turns(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The turns of conversations that begin with some turns of the one that starts their hundred; all conversations.

    Conversation ``c`` takes the first ``crc32(c) % 6`` turns of ``c - c % 100`` and its own behind as many.
    """
    taken = F.crc32(F.col("conv").cast("string")) % 6
    convs = turns.select("conv").distinct()
    first = turns.filter("conv % 100 = 0 and pos < 5").withColumnRenamed("conv", "donor")
    given = convs.select("conv", (F.col("conv") - F.col("conv") % 100).alias("donor"), taken.alias("taken")).join(first, "donor")
    given = given.filter("pos < taken").select(*turns.columns)
    return given.unionByName(turns.filter(F.col("pos") >= taken)), convs


def op13_trie(spark: SparkSession, folder: str) -> DataFrame:
    work = Workspace(spark, "conversations")
    turns = conversations.numbered_turns(work, _table(spark, folder, "conversations"))
    return conversations.prefix_trie(work, *rebuilt_turns(turns))


QUERIES = {
    "op1_neardup": op1_neardup,
    "op2_fingerprints": op2_fingerprints,
    "op3_embeddings": op3_embeddings,
    "op4_language": op4_language,
    "op5_toxicity": op5_toxicity,
    "op6_mixing": op6_mixing,
    "op7_substrings": op7_substrings,
    "op8_packing": op8_packing,
    "op9_quality": op9_quality,
    "op10_token_counts": op10_token_counts,
    "op11_runs": op11_runs,
    "op12_exact": op12_exact,
    "op13_trie": op13_trie,
}

_GROUPS = """
groups AS (
  SELECT id AS start, id AS reached FROM nodes
  UNION
  SELECT g.start, l.b FROM groups g JOIN both_ways l ON l.a = g.reached
),
least AS (SELECT start AS id, min(reached) AS component_id FROM groups GROUP BY start)
"""


def _crc32_sql(text: str) -> str:
    """crc32 of an ASCII string, bit by bit."""
    return f"""xor(4294967295, list_reduce(
    [4294967295]::BIGINT[] || flatten(list_transform(string_split({text}, ''),
      lambda ch: [ascii(ch)]::BIGINT[] || [-1, -1, -1, -1, -1, -1, -1, -1]::BIGINT[])),
    lambda c, x: CASE WHEN x >= 0 THEN xor(c, x) ELSE xor(c >> 1, 3988292384 * (c & 1)) END))"""


ORACLE_SQL: dict[str, str] = {
    "op1_neardup": r"""
WITH RECURSIVE words AS (
  SELECT doc_id AS id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS w
  FROM documents
),
shingles AS (
  SELECT DISTINCT id, array_to_string(w[p : p + 4], ' ') AS s
  FROM (SELECT id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS p FROM words WHERE len(w) > 0)
),
sizes AS (SELECT id, count(*) AS n FROM shingles GROUP BY id),
common AS (
  SELECT x.id AS a, y.id AS b, count(*) AS c FROM shingles x JOIN shingles y ON x.s = y.s AND x.id < y.id GROUP BY ALL
),
links AS (
  SELECT a, b FROM common JOIN sizes x ON x.id = a JOIN sizes y ON y.id = b WHERE 100 * c >= 75 * (x.n + y.n - c)
),
both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
nodes AS (SELECT id FROM words),
""" + _GROUPS + """
SELECT id AS doc_id, coalesce(n, 0) AS n_shingles, component_id, component_id = id AS kept
FROM least LEFT JOIN sizes USING (id)
""",
    "op3_embeddings": """
WITH RECURSIVE vectors AS (
  SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
),
usable AS (
  SELECT id, v FROM vectors
  WHERE len(v) > 0 AND len([x FOR x IN v IF x IS NULL OR NOT isfinite(x)]) = 0 AND len([x FOR x IN v IF x <> 0]) > 0
),
links AS (
  SELECT x.id AS a, y.id AS b FROM usable x JOIN usable y ON x.id < y.id AND len(x.v) = len(y.v)
  WHERE list_cosine_similarity(x.v, y.v) >= 0.95
),
both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
nodes AS (SELECT id FROM vectors),
""" + _GROUPS + """,
counts AS (SELECT a AS id, count(*) AS n FROM both_ways GROUP BY a)
SELECT id AS vec_id, coalesce(n, 0) AS n_links, component_id, component_id = id AS kept
FROM least LEFT JOIN counts USING (id)
""",
    "op7_substrings": r"""
WITH words AS (
  SELECT doc_id AS id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
),
windows AS (
  SELECT id, p, array_to_string(w[p : p + 12], ' ') AS s
  FROM (SELECT id, w, unnest(range(1, len(w) - 11)) AS p FROM words WHERE len(w) >= 13)
),
first AS (SELECT s, min(id) AS low FROM windows GROUP BY s),
gone AS (
  SELECT DISTINCT id, p + j AS p FROM windows JOIN first USING (s), (SELECT unnest(range(0, 13)) AS j) WHERE low < id
),
single AS (SELECT id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM words),
kept AS (
  SELECT id, count(*) AS n, string_agg(word, ' ' ORDER BY p) AS text FROM single ANTI JOIN gone USING (id, p) GROUP BY id
)
SELECT id AS doc_id, len(w) AS n_words, len(w) - coalesce(n, 0) AS n_removed, sha256(coalesce(text, '')) AS kept_sha256
FROM words LEFT JOIN kept USING (id)
""",
    "op10_token_counts": r"""
WITH counts AS (
  SELECT doc_id, source, lang, 'words-1' AS version,
    len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS tokens FROM documents
  UNION ALL
  SELECT doc_id, source, lang, 'marks-1',
    len(regexp_extract_all(coalesce(text, ''), '[A-Za-z0-9]+|[^A-Za-z0-9\x20\x09-\x0D]')) FROM documents
),
now AS (
  SELECT source, CASE WHEN doc_id % 10 = 7 THEN coalesce(lang, 'und') ELSE lang END AS lang, version,
    CASE WHEN doc_id % 10 = 7 THEN 2 * tokens ELSE tokens END AS tokens
  FROM counts WHERE doc_id % 10 <> 3
)
SELECT source, lang, version, count(*) AS docs, CAST(sum(tokens) AS BIGINT) AS tokens FROM now GROUP BY ALL
""",
    "op11_runs": r"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w, """ + _crc32_sql("CAST(doc_id AS VARCHAR)") + """ AS h
  FROM documents
),
sizes AS (SELECT doc_id, w, len(w) AS n, h % 10 = 0 AND len(w) > 0 AS planted, h // 10 AS g FROM words),
places AS (SELECT *, g % n AS a, 1 + (n - g % n) // (3 + g % 8) AS p FROM sizes WHERE n > 0),
single AS (
  SELECT doc_id, i, CASE WHEN planted AND i >= a THEN w[a + (i - a) % p + 1] ELSE w[i + 1] END AS word
  FROM (SELECT *, unnest(range(n)) AS i FROM places)
),
pairs AS (
  SELECT x.doc_id, x.i, y.i - x.i AS q FROM single x JOIN single y ON x.doc_id = y.doc_id AND x.word = y.word AND x.i < y.i
),
stretches AS (
  SELECT doc_id, q, min(i) AS start, count(*) + q AS length
  FROM (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM pairs) GROUP BY doc_id, q, island
),
found AS (
  SELECT doc_id, start, length, min(q) AS period FROM stretches WHERE length >= greatest(12, 2 * q) GROUP BY ALL
),
listed AS (
  SELECT doc_id, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS lines FROM found GROUP BY doc_id
),
longest AS (
  SELECT * FROM found QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY length DESC, start, period) = 1
),
gone AS (SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS i FROM found),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS text FROM single ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, start, length, period, 1000 * length // period AS exponent_milli,
  sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(kept.text, '')) AS collapsed_sha256
FROM documents LEFT JOIN listed USING (doc_id) LEFT JOIN longest USING (doc_id) LEFT JOIN kept USING (doc_id)
""",
    "op12_exact": r"""
WITH texts AS (
  SELECT doc_id, length(coalesce(text, '')) AS n, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS t FROM documents
),
ranked AS (
  SELECT doc_id, t, first_value(doc_id) OVER (PARTITION BY t ORDER BY n DESC, doc_id) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size
  FROM texts
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256 FROM ranked
""",
    "op13_trie": r"""
WITH RECURSIVE turns AS (
  SELECT conv_id AS c, strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '') AS t, length(coalesce(text, '')) AS chars,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) - 1 AS pos
  FROM conversations WHERE conv_id IS NOT NULL
),
convs AS (SELECT DISTINCT c, """ + _crc32_sql("CAST(c AS VARCHAR)") + """ % 6 AS h FROM turns),
rebuilt AS (
  SELECT v.c, pos, t, chars FROM convs v JOIN turns d ON d.c = v.c - v.c % 100 WHERE pos < h
  UNION ALL
  SELECT c, pos, t, chars FROM turns JOIN convs USING (c) WHERE pos >= h
),
depths AS (SELECT c, t, chars, row_number() OVER (PARTITION BY c ORDER BY pos) AS depth FROM rebuilt),
prefixes (c, depth, key, chars) AS (
  SELECT c, CAST(0 AS BIGINT), '', CAST(0 AS BIGINT) FROM convs
  UNION ALL
  SELECT p.c, d.depth, md5(p.key || '/' || d.t), d.chars FROM prefixes p JOIN depths d ON d.c = p.c AND d.depth = p.depth + 1
),
placed AS (
  SELECT c, depth, key, chars, min(c) OVER (PARTITION BY depth, key) AS conv_id, depth = max(depth) OVER (PARTITION BY c) AS ends FROM prefixes
),
nodes AS (
  SELECT conv_id, depth, count(*) AS n_convs, (count(*) - 1) * any_value(chars) AS saved,
    sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (WHERE ends), '')) AS ends_sha256
  FROM placed GROUP BY conv_id, depth
),
parents AS (
  SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id FROM nodes n LEFT JOIN placed p ON p.c = n.conv_id AND p.depth = n.depth - 1
),
children AS (
  SELECT parent_conv_id AS conv_id, depth - 1 AS depth, count(*) AS n_children FROM parents WHERE depth > 0 GROUP BY ALL
),
sums AS (
  SELECT p.conv_id, p.depth, sum(saved) AS saved, sum(CASE WHEN n_children IS NULL THEN 1 ELSE 0 END) AS leaves
  FROM nodes n LEFT JOIN children USING (conv_id, depth) JOIN placed p ON p.c = n.conv_id AND p.depth <= n.depth GROUP BY ALL
)
SELECT conv_id, depth, parent_conv_id, n_convs, coalesce(n_children, 0) AS n_children, CAST(leaves AS BIGINT) AS n_leaves,
  CAST(sums.saved AS BIGINT) AS saved_tokens, ends_sha256
FROM nodes JOIN parents USING (conv_id, depth) LEFT JOIN children USING (conv_id, depth) JOIN sums USING (conv_id, depth)
""",
}
