"""Failures that stop the job, each with the process exit code it maps to."""


class JobStopped(Exception):
    exit_code = 1


class QuarantineRateExceeded(JobStopped):
    exit_code = 2


class EmptyFact(JobStopped):
    exit_code = 3


class ContractViolation(JobStopped):
    exit_code = 4
