"""Role rules."""

from postlake.plans.roles import classify, role_jobs

FIELDS = "platform string, job_id string, job_title string, job_description string, employment_type string, contract_type string, work_type string, part_time boolean, is_active boolean"


def one(spark, **given):
    row = dict(platform="stepstone", job_id="1", job_title=None, job_description=None, employment_type=None, contract_type=None, work_type=None, part_time=None, is_active=True) | given
    return classify(spark.createDataFrame([row], FIELDS)).first()


def test_title_is_a_strong_signal(spark):
    r = one(spark, job_title="Werkstudent:in Data Engineering")
    assert (r["is_working_student"], r["target_role_confidence"], r["target_role_confidence_rank"]) == (True, "high", 3)
    assert r["match_reasons"] == ["working_student.title_terms"]


def test_words_inside_other_words_do_not_match(spark):
    assert not one(spark, job_title="Student Success Manager")["is_target_role"]
    assert not one(spark, job_title="Internal Tools Engineer")["is_internship"]
    assert not one(spark, job_description="überpraktikum")["is_internship"]


def test_description_only(spark):
    r = one(spark, job_description="We offer an internship.")
    assert (r["is_internship"], r["target_role_confidence"], r["match_sources"]) == (True, "medium", ["description"])
    assert one(spark, platform="linkedin", employment_type="Full-time", job_description="We offer an internship.")["target_role_confidence"] == "low"


def test_strong_role_suppresses_description_of_another(spark):
    r = one(spark, job_title="Working Student", job_description="internship, Teilzeit")
    assert (r["is_working_student"], r["is_internship"], r["is_part_time"]) == (True, False, True)


def test_structured_values_by_platform(spark):
    assert one(spark, platform="xing", employment_type="Student")["match_reasons"] == ["working_student.xing_employment_type"]
    assert one(spark, platform="linkedin", employment_type="Student")["is_working_student"] is False
    assert one(spark, part_time=True)["match_reasons"] == ["part_time.part_time_flag"]
    assert one(spark, platform="linkedin", employment_type=" ")["part_time_flag"] is None


def test_no_signal_has_no_confidence(spark):
    r = one(spark, job_title="Senior Consultant")
    assert (r["target_role_confidence"], r["target_role_confidence_rank"], r["match_sources"]) == (None, None, [])


def test_role_jobs_need_activity(spark):
    rows = [("stepstone", str(i), "Werkstudent", None, None, None, None, None, a) for i, a in enumerate([True, False, None])]
    assert [r["job_id"] for r in role_jobs(classify(spark.createDataFrame(rows, FIELDS))).collect()] == ["0"]
