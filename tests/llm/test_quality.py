"""The rules of line-first cleaning, in four languages."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tidemark.llm import quality

STAYS = [
    "A sentence that ends.", "Une phrase qui finit !", "¿Una pregunta que termina?", "So sagte er: „Ja.”", "", " \t",
    "a -> b and so on.", "Five > four | three.", "He reserved all his rights.", "Die Rechte der Frau vorbehaltlos stärken.",
]
GOES = [
    "no end", "Home", "Home > Products > Shoes > Running.", "Start » Shop » Schuhe » Laufen.", "a | b | c | d.",
    "All Rights Reserved.", "Alle Rechte vorbehalten.", "Tous droits réservés.", "Todos los derechos reservados.",
    "Bitte lesen Sie unsere Datenschutzerklärung.", "Lisez notre politique de confidentialité.", "Suscríbete ahora.",
    "### $$$ %%%.", "Conditions d'utilisation.",
]


@pytest.mark.parametrize("separator", ["\n", "\n\n"])
def test_lines(spark, separator):
    text = separator.join(x for pair in zip(STAYS + [""] * 9, GOES + [""] * 9) for x in pair)
    row = spark.createDataFrame([(text,)], "text string").select(quality.kept_lines(F.col("text")).alias("k")).first()
    kept = [x for x in row["k"] if x.strip()]
    assert kept == [x for x in STAYS if x.strip()]
