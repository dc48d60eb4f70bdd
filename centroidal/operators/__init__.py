"""DataFrame operators: preparation, assignment, seeding, Lloyd iterations, evaluation, run history."""
