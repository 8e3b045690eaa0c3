"""Text functions against the reference's own expectations."""
import hashlib
import json

from conftest import one
from pyspark.sql import functions as F

from comms_lake.functions import html as H
from comms_lake.functions import text as X


def col1(spark, value, fn):
    df = spark.createDataFrame([(value,)], "v string")
    return one(df.select(fn(F.col("v")).alias("o")), "o")


def test_slug_ascii_cases(spark):
    assert col1(spark, "Año Nuevo: ¿qué «plan»?", X.slug_ascii) == "ano-nuevo-que-plan"
    assert col1(spark, "", X.slug_ascii) == "sin-asunto"
    assert col1(spark, "con", X.slug_ascii) == "item-con"
    assert col1(spark, "Straße", X.slug_ascii) == "strae"      # sharp s has no ASCII base: dropped
    long = col1(spark, "palabra " * 40, X.slug_ascii)
    assert len(long) <= 60 and not long.endswith("-") and long.startswith("palabra-palabra")


def test_slug_plain_turns_accents_into_dashes(spark):
    assert col1(spark, "Revisión café", X.slug_plain) == "revisi-n-caf"
    assert col1(spark, "", X.slug_plain) == "unknown"
    assert col1(spark, "LPT1", X.slug_plain) == "item-lpt1"


def test_yaml_quote_survives_hostile_subjects(spark):
    hostile = "Sí: [x]\t'y' \"z\"\n---\nfin\u2028más\x85otra\x07voz \\ ya"
    quoted = col1(spark, hostile, X.yaml_quote)
    assert "\n" not in quoted
    assert json.loads(quoted) == hostile
    assert "\\u2028" in quoted and "\\u0085" in quoted and "\\u0007" in quoted


def test_one_line_collapses_unicode_whitespace(spark):
    assert col1(spark, " a  b\x1cc\n\td ", X.one_line) == "a b c d"


def test_truncate_utf8_keeps_whole_characters(spark):
    limit = 100 * 1024
    out = col1(spark, "ñ" * 60_000, lambda c: X.truncate_utf8(c, limit))
    assert len(out.encode("utf-8")) <= limit
    assert out == "ñ" * (limit // 2)
    odd = col1(spark, "a" + "€" * 10, lambda c: X.truncate_utf8(c, 6))   # 1 + 3 + (2 of 3) bytes
    assert odd == "a€"
    for n in range(12):  # every cut of characters of 1 to 4 bytes; a genuine U+FFFD stays
        text = "a€\ufffdñ😀b"
        want = text.encode()[:n].decode("utf-8", "ignore")
        assert col1(spark, text, lambda c: X.truncate_utf8(c, n)) == want, n


def test_size_label_rounds_half_even(spark):
    df = spark.createDataFrame([(1,), (512,), (1536,), (2560,), (None,)], "s bigint")
    got = [r[0] for r in df.select(X.size_label(F.col("s"))).collect()]
    assert got == ["1 KB", "1 KB", "2 KB", "2 KB", "tamaño desconocido"]


def test_short_hashes_match_sha1(spark):
    assert col1(spark, "m42", lambda c: X.sha_hex(c, 6)) == hashlib.sha1(b"m42").hexdigest()[:6]


def test_html_body_to_text(spark):
    df = spark.createDataFrame([("<h2>Acta</h2><style>h2 > b {top: 0}</style>Punto<br/>aparte<ol><li>firmar</li><li>enviar</li></ol>",),
                                ("<!-- borrador --><section>3 &lt; 5 &nbsp;</section><script>if (a < b) { run('<p>') }</script>",)], "v string")
    got = [r[0] for r in H.html_to_text(df, "v", "t").orderBy(F.length("v").desc()).select("t").collect()]
    assert sorted(got) == sorted(["Acta\nPunto\n\naparte\n- firmar\n\n- enviar", "3 < 5"])


def test_message_document_exact_text(spark):
    from comms_lake.operators import documents as DOC
    addr = "struct<emailAddress:struct<name:string,address:string>>"
    df = spark.createDataFrame([(
        "m1", "<m1@x>", 'Hola "mundo"', __import__("datetime").datetime(2024, 3, 1, 9, 5),
        {"emailAddress": {"name": "Ana", "address": "ana@x"}}, {"emailAddress": {"name": "B", "address": "b@x"}},
        [{"emailAddress": {"name": "Luis", "address": "LUIS@x"}}], [], "c1", "Entrada",
        [{"name": "doc.pdf", "content_type": "application/pdf", "size": 1536}], False,
        "text", "línea 1\r\n---\r\nfin\n\n", "", "acme", "yo@x", "I")],
        f"id string, internet_id string, subject string, received timestamp_ntz, from_entry {addr}, "
        f"sender_entry {addr}, to_entries array<{addr}>, cc_entries array<{addr}>, conversation_id string, "
        "carpeta string, attachments array<struct<name:string,content_type:string,size:bigint>>, "
        "attachments_error boolean, content_type string, content string, preview string, empresa string, "
        "cuenta string, ingestado string")
    got = DOC.render_mail(DOC.with_body_text(df)).first()["content"]
    assert got == (
        '---\nfuente: correo\nempresa: "acme"\ncuenta: "yo@x"\nfecha: 2024-03-01T09:05:00+00:00\n'
        'creationDate: 2024-03-01\nid_origen: "m1"\nid_internet: "<m1@x>"\nparticipantes:\n'
        '  - "Ana <ana@x>"\n  - "Luis <luis@x>"\nasunto: "Hola \\"mundo\\""\nproyecto:\ncarpeta: "Entrada"\n'
        'hilo: "c1"\nadjuntos:\n  - "doc.pdf"\ningestado: I\n---\n\n## Adjuntos\n\n- doc.pdf (application/pdf, 2 KB)\n\n'
        "## Cuerpo\n\nlínea 1\n\\---\nfin\n")


def test_message_body_limit_is_a_parameter(spark):
    from comms_lake.operators import documents as DOC
    addr = "struct<emailAddress:struct<name:string,address:string>>"
    df = spark.createDataFrame([("m", "", "s", __import__("datetime").datetime(2024, 3, 1), None, None, [], [], "", "", [], False,
                                 "é" * 3000, "e", "c", "I")],
                               f"id string, internet_id string, subject string, received timestamp_ntz, from_entry {addr}, "
                               f"sender_entry {addr}, to_entries array<{addr}>, cc_entries array<{addr}>, conversation_id string, "
                               "carpeta string, attachments array<struct<name:string,content_type:string,size:bigint>>, "
                               "attachments_error boolean, body_text string, empresa string, cuenta string, ingestado string")
    assert "é" * 3000 in DOC.render_mail(df).first()["content"]
    cut = DOC.render_mail(df, max_bytes=2049).first()["content"]
    assert cut.endswith("é" * 1024 + "\n\n[...truncado a 2 KB]\n") and "é" * 1025 not in cut
