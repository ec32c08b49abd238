"""Column expressions: bit fields, headers, candidates, kinematics."""
