"""Pure ``DataFrame -> DataFrame`` operators.  None of them triggers a job or writes."""
