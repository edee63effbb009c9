import json

import pytest

from segmint.spec import FILE_CAP_BYTES, AudienceSpec, PiiField, parts_for

FILE_MAPPING = ('[{"column_name":"e-mail", "pii_type":"EMAIL"}, '
                '{"column_name":"phone_number", "pii_type":"PHONE"}, '
                '{"column_name":"mobile_advertiser_id", "pii_type":"GAID"}]')
BATCH_MAPPING = FILE_MAPPING.replace('"GAID"', '"MOBILE_AD_ID"')


def test_file_mapping_parses():
    spec = AudienceSpec.from_args("file", FILE_MAPPING, "myaudience", "mydata.json")
    assert spec.mapped_columns == ["e-mail", "phone_number", "mobile_advertiser_id"]
    assert spec.output_names == ["EMAIL_SHA256", "PHONE_SHA256", "GAID_SHA256"]


def test_batch_mapping_parses():
    spec = AudienceSpec.from_args("batch", json.loads(BATCH_MAPPING), "seg")
    assert spec.output_names[-1] == "MOBILE_AD_ID_SHA256"
    assert spec.rows_per_file == 100_000


def test_unknown_type_rejected():
    with pytest.raises(ValueError):
        AudienceSpec.from_args("file", FILE_MAPPING.replace("GAID", "MOBILE_AD_ID"), "s")
    with pytest.raises(ValueError):
        AudienceSpec.from_args("batch", FILE_MAPPING, "s")


def test_duplicate_type_or_column_rejected():
    dup_type = [{"column_name": "a", "pii_type": "EMAIL"}, {"column_name": "b", "pii_type": "EMAIL"}]
    dup_col = [{"column_name": "a", "pii_type": "EMAIL"}, {"column_name": "a", "pii_type": "PHONE"}]
    for m in (dup_type, dup_col):
        with pytest.raises(ValueError):
            AudienceSpec.from_args("file", m, "s")


def test_segment_name_guard_and_empty_mapping():
    with pytest.raises(ValueError):
        AudienceSpec.from_args("file", FILE_MAPPING, "a/b")
    with pytest.raises(ValueError):
        AudienceSpec.from_args("file", "[]", "s")


def test_strict_byte_cap():
    spec = AudienceSpec("file", (PiiField("x", "EMAIL"),), "s")
    assert spec.rows_per_file * 65 <= FILE_CAP_BYTES < (spec.rows_per_file + 1) * 65
    # 1,613,193 rows need 3 parts under the strict cap (2 would exceed it by 5 bytes)
    assert parts_for(1_613_193, spec.rows_per_file) == 3
    assert parts_for(0, 10) == 0


def test_read_schema_is_string_for_mapped():
    spec = AudienceSpec("file", (PiiField("phone", "PHONE"),), "s",
                        extra_columns=(("age", "LONG"),))
    names = {f.name: f.dataType.simpleString() for f in spec.read_schema()}
    assert names == {"phone": "string", "age": "bigint"}


def test_parity_and_mode_options_validated():
    with pytest.raises(ValueError):
        AudienceSpec.from_args("file", FILE_MAPPING, "s", include_unmapped=True)
    with pytest.raises(ValueError):
        AudienceSpec.from_args("batch", BATCH_MAPPING, "s", read_mode="DROPMALFORMED")
    with pytest.raises(ValueError):
        AudienceSpec.from_args("batch", BATCH_MAPPING, "s", null_policy="drop")
    ok = AudienceSpec.from_args("batch", BATCH_MAPPING, "s", include_unmapped=True,
                                extra_columns=(("city", "STRING"),),
                                read_mode="PERMISSIVE", null_policy="literal")
    assert ok.include_unmapped and ok.read_mode == "PERMISSIVE"


def test_upload_name():
    from segmint.plans.jobs import upload_name
    assert upload_name("mydata.json") == "mydata.json"
    assert upload_name("/uploads/2024/list.v2.csv") == "uploads/2024/list.v2.csv"
    assert upload_name("") == "upload"


def test_include_unmapped_needs_the_columns():
    import pytest
    args = ("batch", '[{"column_name":"e","pii_type":"EMAIL"}]', "s")
    with pytest.raises(ValueError, match="extra_columns"):
        AudienceSpec.from_args(*args, include_unmapped=True)
    AudienceSpec.from_args(*args, include_unmapped=True, extra_columns=(("city", "STRING"),))
