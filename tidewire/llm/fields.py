"""Those columns of the operators' queries that SQL can say, as queries of their own with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import fingerprints, lm, mixing, pii, token_counts

_WORDS = r"regexp_extract_all(coalesce({0}, ''), '[^\x20\x09-\x0D]+')"
_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
#: The public CRC-32, bit by bit, of a number's decimal digits.
_CRC = """xor(list_reduce(list_prepend(4294967295, flatten(list_transform(string_split(cast(doc_id as varchar), ''), lambda c: [ord(c), -1, -1, -1, -1, -1, -1, -1, -1]))),
  lambda c, x: case when x >= 0 then xor(c, x) when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end), 4294967295)"""
_HELD = f"coalesce({_CRC} % 5 = 1, false)"
_DIGITS = "regexp_replace({0}, '[^0-9]', '', 'g')"
_LUHN = f"""list_sum(list_transform(range(1, len({_DIGITS.format('m')}) + 1), lambda i: case when i % 2 = 1 then cast({_DIGITS.format('m')}[-i] as int)
  else (2 * cast({_DIGITS.format('m')}[-i] as int)) // 10 + (2 * cast({_DIGITS.format('m')}[-i] as int)) % 10 end)) % 10 = 0"""


def _matches(pattern: str, holds: str) -> str:
    return f"len(list_filter(regexp_extract_all(coalesce(text, ''), '{pattern}'), lambda m: {holds}))"


def fields_op1_mixing(spark, sf_dir: str) -> DataFrame:
    return mixing.query(spark, sf_dir).select("doc_id", "size", "source_size", F.round("target", 3).alias("target"))


def fields_op2_fingerprints(spark, sf_dir: str) -> DataFrame:
    return fingerprints.query(spark, sf_dir).select("doc_id", "n_chars", "edited_sha256")


def fields_op3_token_counts(spark, sf_dir: str) -> DataFrame:
    return token_counts.query(spark, sf_dir).select("doc_id", "n_bytes")


def fields_op8_lm_scoring(spark, sf_dir: str) -> DataFrame:
    return lm.base(spark, sf_dir).select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", F.round("base_score", 4).alias("base_score"))


def fields_op9_pii(spark, sf_dir: str) -> DataFrame:
    return pii.query(spark, sf_dir).select("doc_id", "n_email", "n_ip", "n_card", "n_phone")


QUERIES = (fields_op1_mixing, fields_op2_fingerprints, fields_op3_token_counts, fields_op8_lm_scoring, fields_op9_pii)

SQL = {
    "fields_op1_mixing": f"""with d as (select doc_id, source, len({_WORDS.format('text')}) size from documents),
      s as (select source, cast(sum(size) as bigint) s, [5.0, 2.0, 1.0][1 + (row_number() over (order by source nulls last) - 1) % 3]::double w from d group by 1),
      r as (select *, 3.0 * s / w ratio, sum(3.0 * s) over o - 3.0 * s capped, sum(w) over () - (sum(w) over o - w) rest, sum(s) over () total from s window o as (order by 3.0 * s / w, source rows unbounded preceding)),
      l as (select min_by((total - capped) / rest, ratio) level from r where (total - capped) / rest <= ratio)
      select doc_id, cast(size as bigint) size, s source_size, round(least(3.0 * s, level * w), 3) target from d join s on d.source is not distinct from s.source, l""",
    "fields_op2_fingerprints": """with d as (select doc_id, coalesce(text, '') t, coalesce(lead(text) over (order by doc_id), first_value(text) over (order by doc_id), '') n from documents)
      select doc_id, length(t) n_chars, sha256(left(t, length(t) - length(t) // 2) || left(n, length(t) // 2)) edited_sha256 from d""",
    "fields_op3_token_counts": "select doc_id, strlen(coalesce(text, '')) n_bytes from documents",
    "fields_op8_lm_scoring": f"""with d as (select doc_id, {_HELD} held_out, list_append({_WORDS.format(_LOWER)}, chr(10)) ws from documents), e as (select doc_id, held_out, unnest(ws) w from d),
      c as (select w, count(*) c from e where not held_out group by 1), t as (select cast(sum(c) as bigint) n, count(*) v from c)
      select doc_id, held_out, count(*) n_tokens, count(c) n_known, n train_tokens, round(sum(log10((coalesce(c, 0) + 0.5::double) / (n + 0.5 * (v + 1)))), 4) base_score from e left join c using (w), t group by doc_id, held_out, n""",
    "fields_op9_pii": f"""select doc_id, {_matches('[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:[.][A-Za-z0-9-]+)+', 'true')} n_email,
      {_matches('[0-9]+(?:[.][0-9]+)(?:[.][0-9]+)(?:[.][0-9]+)', "list_max(list_transform(string_split(m, '.'), lambda p: coalesce(try_cast(p as bigint), 999))) <= 255")} n_ip,
      {_matches('[0-9](?:[ -]?[0-9])+', f"len({_DIGITS.format('m')}) between 14 and 19 and {_LUHN}")} n_card,
      {_matches('[+][0-9][ ().0-9-]+[0-9]', f"len({_DIGITS.format('m')}) between 10 and 15")} n_phone from documents""",
}
