from __future__ import annotations

import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .appName("textloom-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "6g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


HEADLINES = [
    ("भारताने सामन्यात विजय मिळवला", "Sports"),
    ("भारतीय संघाने सामना जिंकला विजय मिळवला", "Sports"),
    ("क्रिकेट संघाने मालिका जिंकली", "Sports"),
    ("क्रिकेट सामन्यात भारतीय संघाचा विजय", "Sports"),
    ("मुख्यमंत्री यांची महत्त्वाची बैठक", "Politics"),
    ("मुख्यमंत्री दिल्लीत दाखल बैठक सुरू", "Politics"),
    ("निवडणूक आयोगाची बैठक", "Politics"),
    ("निवडणूक प्रचार सुरू मुख्यमंत्री मैदानात", "Politics"),
    ("नवीन 5G स्मार्टफोन लाँच", "Tech"),
    ("नवीन स्मार्टफोन भारतात लाँच किंमत 10 हजार", "Tech"),
    ("5G सेवा भारतात सुरू", "Tech"),
    ("सेन्सेक्स घसरला बाजार बंद", "Business"),
    ("बाजार तेजीत सेन्सेक्स वधारला", "Business"),
]


@pytest.fixture(scope="session")
def headlines(spark):
    """A small labelled corpus, already cleaned."""
    from textloom.operators.prepare import prepare

    rows = [(i, text, label, label) for i, (text, label) in enumerate(HEADLINES, 1)]
    return prepare(spark.createDataFrame(rows, "ID long, Text string, Label string, Original_Label string"))
