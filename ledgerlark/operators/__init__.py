"""DataFrame operators: staging, features, marts, reports, audits, checks, distributed ntile."""
