"""Explicit schemas of the layers."""

from __future__ import annotations

from pyspark.sql import types as T

_S, _L, _I, _D, _TS = (
    T.StringType(), T.LongType(), T.IntegerType(), T.DoubleType(), T.TimestampType(),
)


def _schema(fields: list[tuple[str, T.DataType]]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


CARDS = _schema([
    ("id", _L), ("source", _S), ("position", _L), ("lines", T.ArrayType(_S)),
])

BRONZE_TEXT_COLUMNS = [
    "marca_modelo", "versao", "info_line", "preco_bruto", "condicoes",
    "detalhes", "extra1", "extra2", "extra3", "extra4",
]

SILVER = _schema([
    ("id", _L), ("marca", _S), ("modelo", _S), ("versao", _S), ("ano_fabricacao", _I),
    ("ano_modelo", _I), ("km", _L), ("localizacao", _S), ("preco_bruto", _S),
    ("condicoes", _S), ("texto_completo", _S), ("data_coleta", _TS), ("preco", _D),
    ("faixa_preco", _S), ("faixa_km", _S), ("idade_veiculo", _I), ("preco_por_km", _D),
    ("compra_online", _S),
])

GOLD = _schema([
    ("id", _L), ("marca", _S), ("modelo", _S), ("versao", _S), ("ano_fabricacao", _I),
    ("ano_modelo", _I), ("km", _L), ("localizacao", _S), ("compra_online", _S),
    ("preco_bruto", _D), ("preco", _D), ("faixa_preco", _S), ("faixa_km", _S),
    ("idade_veiculo", _I), ("preco_por_km", _D), ("latitude", _D), ("longitude", _D),
    ("texto_completo", _S), ("data_coleta", _TS), ("execucao_tempo_seg", _D),
    ("execucao_memoria_mb", _D), ("execucao_data_hora", _S),
])

GEO_CACHE = _schema([("location", _S), ("lat", _D), ("lon", _D), ("normalized", _S)])

GAZETTEER = _schema([
    ("name", _S), ("lat", _D), ("lon", _D), ("city", _S), ("town", _S), ("village", _S),
    ("suburb", _S), ("municipality", _S), ("state_district", _S), ("state", _S),
])
