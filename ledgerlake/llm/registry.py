"""Names of the corpus queries and their SQL equivalents."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ledgerlake.llm import bpe, labels, mixing, pii, survivor


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "p2_found": survivor.p2_found,
        "p2_survivors": survivor.p2_survivors,
        "p2_consensus": survivor.p2_consensus,
        "p4_found": labels.p4_found,
        "p4_labels": labels.p4_labels,
        "p6_ids": bpe.p6_ids,
        "p7_mix": mixing.p7_mix,
        "p7_shares": mixing.p7_shares,
        "p8_found": pii.p8_found,
        "p8_redacted": pii.p8_redacted,
    }


def oracle_sql() -> dict[str, str]:
    return {"p2_found": P2_FOUND, "p2_survivors": P2_SURVIVORS}


KEYED = r"""
WITH named AS (
  SELECT c.cand_id, c.annee, c.nb_pages, c.score, c.collecte_le, coalesce(s.rang, 1073741824) AS rang,
    lower(CASE WHEN c.url_pdf IS NOT NULL AND trim(c.url_pdf) <> ''
      THEN url_decode(regexp_extract(regexp_replace(c.url_pdf, '[?#].*$', ''), '([^/]*)$', 1))
      ELSE regexp_replace(c.titre, '^\s*\[LOCAL\]\s*', '', 'i') END) AS f
  FROM doc_candidates c LEFT JOIN sources_collecte s ON c.source = s.source
), keyed AS (
  SELECT *, trim(regexp_replace(regexp_replace(regexp_replace(f, '\.pdf$', ''), '( \(\d+\)| - copie)+$', ''), '[\s_-]+', ' ', 'g')) AS cle FROM named
), groups AS (
  SELECT cle, min(cand_id) AS groupe, count(*) AS lignes FROM keyed WHERE cle <> '' GROUP BY cle
), cells AS (
  SELECT cle, 'annee' AS champ, annee AS valeur, cand_id, rang, collecte_le FROM keyed WHERE annee BETWEEN 2000 AND 2030
  UNION ALL SELECT cle, 'nb_pages', nb_pages, cand_id, rang, collecte_le FROM keyed WHERE nb_pages >= 1
  UNION ALL SELECT cle, 'score', score, cand_id, rang, collecte_le FROM keyed WHERE score BETWEEN 1 AND 100
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY cle, champ ORDER BY rang, collecte_le DESC NULLS LAST, cand_id) AS r FROM cells
)
"""
P2_FOUND = KEYED + "SELECT groupe, champ, cand_id FROM ranked JOIN groups USING (cle) WHERE r = 1 AND lignes >= 2"
P2_SURVIVORS = (
    KEYED + "SELECT groupe, cle, lignes, "
    + ", ".join(f"max(CASE WHEN champ = '{c}' THEN valeur END)::BIGINT AS {c}, max(CASE WHEN champ = '{c}' THEN cand_id END) AS {c}_cand_id" for c in ("annee", "nb_pages", "score"))
    + " FROM groups LEFT JOIN (SELECT * FROM ranked WHERE r = 1) USING (cle) GROUP BY groupe, cle, lignes"
)
