"""Declared names: states, months, eras, rename maps. Everything at rest is text."""

from __future__ import annotations

from pyspark.sql import types as T

# The 27 federal units, and the two groups that the 2000-2005 denominators tell apart.
UFS = ("AC", "AL", "AM", "AP", "BA", "CE", "DF", "ES", "GO", "MA", "MG", "MS", "MT", "PA", "PB", "PE", "PI", "PR", "RJ", "RN", "RO", "RR", "RS", "SC", "SE", "SP", "TO")
STATE_GROUP_A = ("AL", "AM", "BA", "CE", "MA", "MG", "MT", "PA", "PB", "PI", "RO", "TO")
# States without aggregated data in the first years.
NO_DATA = {1994: ("AL", "AP", "DF", "MS", "MG", "PB", "PR", "RJ", "RS", "SP", "SE", "TO"), 1995: ("MS", "MG", "TO"), 1996: ("MG",)}
#: Month names as publishers write them in file names.
MONTHS = ("jan", "fev", "mar", "abr", "mai", "jun", "jul", "ago", "set", "out", "nov", "dez")

# Modern names of live-birth fields and those of 1994-1995, and that era's control fields.
BIRTH_RENAMES = {
    "CODIGO": "NUMERODN", "LOCAL_OCOR": "LOCNASC", "MUNI_OCOR": "CODMUNNASC", "ESTAB_OCOR": "CODESTAB", "DATA_NASC": "DTNASC", "SEXO": "SEXO",
    "PESO": "PESO", "RACACOR": "RACACOR", "APGAR1": "APGAR1", "APGAR5": "APGAR5", "GESTACAO": "GESTACAO", "TIPO_GRAV": "GRAVIDEZ",
    "TIPO_PARTO": "PARTO", "PRE_NATAL": "CONSULTAS", "IDADE_MAE": "IDADEMAE", "INSTR_MAE": "ESCMAE", "MUNI_MAE": "CODMUNRES",
    "FIL_VIVOS": "QTDFILVIVO", "FIL_MORTOS": "QTDFILMORT", "UFINFORM": "UFINFORM",
}
BIRTH_CONTROL = ("ETNIA", "FIL_ABORT", "NUMEXPORT", "CRITICA")

#: First year of each era; a dataset's label changes at each.
ERAS = {"doses": (1994, 2004, 2013), "coverage": (1994, 2013), "births": (1994, 1996), "admissions": (1992, 2008)}

INVALID = "_invalid"


def all_string(names: list[str] | tuple[str, ...]) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


LEDGER = (
    "unit string, etag string, size_bytes bigint, digest string, n_rows bigint, n_columns int, processed_at timestamp")
OUTPUT_FILE = "struct<path:string,size_bytes:bigint,sha256:string,record_count:bigint>"
PARTITION = (f"struct<source_url:string,source_size_bytes:bigint,source_etag:string,source_last_modified:string,processing_timestamp:string,"
             f"output_files:array<{OUTPUT_FILE}>,total_records:bigint,total_size_bytes:bigint>")
MANIFEST = f"manifest_version string, dataset string, last_updated string, pipeline_version string, partitions map<string,{PARTITION}>"
BASELINE = "generated_at string, source string, endpoint string, total bigint, counts map<string,bigint>"
