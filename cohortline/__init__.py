"""Customer-lifecycle analytics on enrolment spells, expressed as Spark DataFrame jobs."""
