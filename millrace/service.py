"""HTTP service: GET /health, POST /config/validate and POST /jobs/run."""

from __future__ import annotations

import json
import os
from collections.abc import Mapping
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer
from typing import Any

from pyspark.sql import SparkSession

from millrace.plans.job import Options, error, run_pipeline
from millrace.plans.validate import validate_config

REQUIRED = ("S3_BUCKET", "AWS_ACCESS_KEY_ID", "AWS_SECRET_ACCESS_KEY", "AWS_REGION", "AWS_ENDPOINT_URL")
_STATUS = {"no_s3_client": 500, "config_read_failed": 400, "config_parse_failed": 400, "config_invalid": 400, "bad_request": 400}


def require_env(env: Mapping[str, str] | None = None, names: tuple[str, ...] = REQUIRED) -> None:
    """Raise unless every variable is set and not empty; the message names all that are missing."""
    env = os.environ if env is None else env
    missing = [n for n in names if not env.get(n)]
    if missing:
        raise RuntimeError(f"missing required environment variable(s): {', '.join(missing)}")


def store_settings(env: Mapping[str, str]) -> dict[str, str]:
    """Spark settings for the object store that the variables name."""
    return {
        "spark.hadoop.fs.s3a.endpoint": env["AWS_ENDPOINT_URL"],
        "spark.hadoop.fs.s3a.endpoint.region": env["AWS_REGION"],
        "spark.hadoop.fs.s3a.access.key": env["AWS_ACCESS_KEY_ID"],
        "spark.hadoop.fs.s3a.secret.key": env["AWS_SECRET_ACCESS_KEY"],
        "spark.hadoop.fs.s3a.path.style.access": "true",
    }


def respond(method: str, path: str, body: bytes, spark: SparkSession | None, root: str | None) -> tuple[int, Any]:
    """Status and document (text for /health) of one request. A job's body may have ``options``: see ``Options``."""
    if (method, path) == ("GET", "/health"):
        return 200, "ok"
    if (method, path) == ("POST", "/config/validate"):
        return 200, validate_config(body)
    if (method, path) == ("POST", "/jobs/run"):
        try:
            doc = json.loads(body)
            prefix, clean = doc["pipeline_prefix"], doc.get("clean_run", False)
            if not (isinstance(prefix, str) and isinstance(clean, bool)):
                raise TypeError("pipeline_prefix must be text and clean_run a boolean")
            options = Options.parse(doc.get("options", {}))
        except (ValueError, KeyError, TypeError, AttributeError) as e:
            return 400, error("bad_request", str(e))
        if spark is None or root is None:
            return 500, error("no_s3_client", "S3 client not configured")
        report = run_pipeline(spark, root, prefix, clean, options)
        return _STATUS.get(report.get("error", {}).get("kind"), 200), report
    return 404, error("not_found", f"{method} {path}")


def server(spark: SparkSession | None, root: str | None, port: int = 8080) -> ThreadingHTTPServer:
    class Handler(BaseHTTPRequestHandler):
        def _answer(self) -> None:
            body = self.rfile.read(int(self.headers.get("Content-Length") or 0))
            status, doc = respond(self.command, self.path, body, spark, root)
            data = doc.encode() if isinstance(doc, str) else json.dumps(doc).encode()
            self.send_response(status)
            self.send_header("Content-Type", "text/plain" if isinstance(doc, str) else "application/json")
            self.send_header("Content-Length", str(len(data)))
            self.end_headers()
            self.wfile.write(data)

        do_GET = do_POST = _answer

    return ThreadingHTTPServer(("0.0.0.0", port), Handler)


def main() -> None:
    require_env()
    builder = SparkSession.builder.appName("millrace")
    spark = builder.config(map=store_settings(os.environ)).getOrCreate()
    server(spark, f"s3a://{os.environ['S3_BUCKET']}", int(os.environ.get("PORT") or 8080)).serve_forever()


if __name__ == "__main__":
    main()
