"""Check names, codes and message text of the validation report.

The text is part of the output contract (the metrics document carries it), so
it is kept verbatim here as fixed values.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Check names, codes, messages and status words.
# ---------------------------------------------------------------------------
CHECK_DUPLICATE = "duplicate_check"
CHECK_NULL = "null_check"
CHECK_TYPE = "type_consistency_check"

CODE_OK = 200
CODE_BAD_DATA = 400
CODE_CONFLICT = 409

MSG_DUPLICATE_FAIL = "Registros duplicados encontrados: {n} registros com base no 'id'."
MSG_DUPLICATE_OK = "Nenhum registro duplicado encontrado."
MSG_NULL_FAIL = "Valores nulos encontrados nas colunas: {issues}."
MSG_NULL_OK = "Nenhum valor nulo encontrado nas colunas criticas."
MSG_TYPE_FAIL = "Valores não numéricos encontrados na coluna 'rating'."
MSG_TYPE_OK = "Consistência dos tipos de dados verificada com sucesso."

STATUS_PASS = "PASSOU"
STATUS_FAIL = "FALHOU"
SUMMARY_HEADER = "[*] Validação da ingestão concluída para {n} registros."
# ---------------------------------------------------------------------------


def _split_template(template: str, slot: str) -> tuple[str, str]:
    head, tail = template.split("{" + slot + "}")
    return head, tail


def duplicate_message(n_groups: Column) -> Column:
    head, tail = _split_template(MSG_DUPLICATE_FAIL, "n")
    return F.when(n_groups > 0, F.concat(F.lit(head), n_groups.cast("string"), F.lit(tail))).otherwise(
        F.lit(MSG_DUPLICATE_OK)
    )


def null_issues_text(counts: dict[str, Column]) -> Column:
    """Text of a Python dict literal of the columns with NULLs, e.g.
    ``{'id': 2, 'date': 1}`` — the columns keep the given order."""
    parts = [
        F.when(c > 0, F.concat(F.lit(f"'{name}': "), c.cast("string")))
        for name, c in counts.items()
    ]
    joined = F.array_join(F.filter(F.array(*parts), lambda x: x.isNotNull()), ", ")
    return F.concat(F.lit("{"), joined, F.lit("}"))


def null_message(counts: dict[str, Column]) -> Column:
    any_null = None
    for c in counts.values():
        any_null = (c > 0) if any_null is None else (any_null | (c > 0))
    head, tail = _split_template(MSG_NULL_FAIL, "issues")
    return F.when(any_null, F.concat(F.lit(head), null_issues_text(counts), F.lit(tail))).otherwise(
        F.lit(MSG_NULL_OK)
    )


def type_message(n_bad: Column) -> Column:
    return F.when(n_bad > 0, F.lit(MSG_TYPE_FAIL)).otherwise(F.lit(MSG_TYPE_OK))


def check_label(check: Column) -> Column:
    """``null_check`` -> ``Null Check`` (title case of the words)."""
    return F.initcap(F.regexp_replace(check, "_", " "))


def status_word(status: Column) -> Column:
    return F.when(status, F.lit(STATUS_PASS)).otherwise(F.lit(STATUS_FAIL))


def summary_header(total: Column) -> Column:
    head, tail = _split_template(SUMMARY_HEADER, "n")
    return F.concat(F.lit(head), total.cast("string"), F.lit(tail))
