import json

import pytest

from editloom import jobs


def lines(path):
    return [json.loads(x) for f in sorted(path.glob("part*")) for x in f.read_text().splitlines()]


def response(i):
    return {
        "commit": [f"a{i}", "b"], "code_snippet": ["s"],
        "response_1": f"### [Program Before Edit]\n```python\nx = {i}\ny = 1\n```\n### [Descriptive]\n** Change x {'apple' if i % 2 else 'engine'} **\n### [Lazy]\n- change\n---\nend",
        "response_2": f"### [Program After Edit]\n```python\nx = {i + 1}\ny = 1\n```\n",
    }


def test_from_responses_to_training_rows(spark, tmp_path):
    p = {k: str(tmp_path / k) for k in ("responses", "triplets", "mix", "filtered", "train")}
    (tmp_path / "responses").write_text("".join(json.dumps(response(i)) + "\n" for i in range(40)) + json.dumps({"response_1": "no", "response_2": ""}) + "\n\n{broken\n")
    jobs.run_extract(spark, {"input": p["responses"], "output": p["triplets"]})
    rows = lines(tmp_path / "triplets")
    assert len(rows) == 40 and rows[0]["commit"] == "a0,b" and rows[0]["code_before_purify"] == "x = 0\ny = 1" and rows[0]["instruct_lazy_purify"] == "change"
    jobs.run_mix(spark, {"input_files": [p["triplets"]] * 2, "ratios": [0.5, 0.5], "instr_types": ["descriptive", "lazy"], "model_names": ["m", "m"], "output_file": p["mix"], "total_samples": 30})
    assert sorted(r["instr_type"] for r in lines(tmp_path / "mix")) == ["m_descriptive"] * 15 + ["m_lazy"] * 15
    jobs.run_filter(spark, {"jsonl_path": p["mix"], "field_name": ["code_before_purify", "instruct_purify"], "output_path": p["filtered"], "filter_settings": {"max_samples_total": 20, "topics": 3}})
    assert len(lines(tmp_path / "filtered")) == 20
    jobs.run_finetune(spark, {"input_files": [p["filtered"]], "output_file": p["train"]})
    out = lines(tmp_path / "train")
    assert len(out) == 20 and [m["role"] for m in out[0]["messages"]] == ["system", "user", "assistant"] and out[0]["new_code"].startswith("x = ")


def test_report(spark, tmp_path, capsys):
    (tmp_path / "d/run").mkdir(parents=True)
    (tmp_path / "d/run/1.results.json").write_text(json.dumps({"id": 1, "before": "a", "instr_kind": "lazy", "taxonomy": {"change_kind": "x"}, "results": [{"status": "OK", "exit_code": 0, "program_no_test": "a"}]}))
    jobs.run_report(spark, {"paths": str(tmp_path / "d"), "output": str(tmp_path / "sheet")})
    assert capsys.readouterr().out.splitlines()[1] == "d,run,1,100.0,1,1,1,NA,NA,NA"


def test_bad_calls(tmp_path):
    assert jobs.main(["nothing"]) == 2
    with pytest.raises(ValueError):
        jobs.run_mix(None, {"input_files": [1], "ratios": [], "instr_types": [], "model_names": []})
