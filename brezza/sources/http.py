"""HTTP with retries, and the services of the sources as Spark data sources: one task per page or per chunk of locations."""

from __future__ import annotations

import json
import time
import urllib.error
import urllib.parse
import urllib.request
from collections.abc import Callable, Iterator
from typing import Any, Protocol, TypeVar

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from brezza.errors import FormatError, TransportError

MAX_BODY_BYTES = 256 * 1024 * 1024
TIMEOUT_SECONDS = 60.0
Parsed = TypeVar("Parsed")


class Transport(Protocol):
    """Gives the body of a URL, or raises ``TransportError`` with the status."""

    def __call__(self, url: str, params: dict[str, str]) -> bytes: ...


class UrlTransport:
    """Gets a URL; a body beyond ``limit`` bytes is never held in memory."""

    def __init__(self, timeout: float = TIMEOUT_SECONDS, limit: int = MAX_BODY_BYTES):
        self._timeout, self._limit = timeout, limit

    def __call__(self, url: str, params: dict[str, str]) -> bytes:
        try:
            with urllib.request.urlopen(f"{url}?{urllib.parse.urlencode(params)}" if params else url, timeout=self._timeout) as answer:
                body = answer.read(self._limit + 1)
        except urllib.error.HTTPError as e:
            raise TransportError(f"{url}: {e.reason}", status=e.code) from e
        except (OSError, urllib.error.URLError) as e:
            raise TransportError(f"{url}: {e}") from e
        if len(body) > self._limit:
            raise TransportError(f"{url} answered more than {self._limit} bytes", status=413)
        return body


def get(transport: Transport, url: str, params: dict[str, str], attempts: int = 4, pause: float = 1.0, sleep: Callable[[float], Any] = time.sleep) -> str:
    """The text of a URL.  No answer, 429 and server errors are tried again after doubling pauses; other errors are final."""
    for attempt in range(attempts):
        try:
            body = transport(url, params)
        except TransportError as e:
            if not e.retryable or attempt + 1 == attempts:
                raise
            sleep(pause * 2**attempt)
            continue
        if len(body) > MAX_BODY_BYTES:
            raise TransportError(f"{url} answered {len(body)} bytes", status=413)
        try:
            return body.decode()
        except UnicodeDecodeError as e:
            raise FormatError(f"{url} did not answer UTF-8") from e
    raise TransportError(f"{url}: no attempts were allowed")


def get_parsed(
    transport: Transport, url: str, params: dict[str, str], parse: Callable[[str], Parsed], attempts: int = 4, pause: float = 1.0, sleep: Callable[[float], Any] = time.sleep
) -> Parsed:
    """What ``parse`` makes of a URL's text.  A body that does not parse may have been cut short: it is fetched again as often as one that failed."""
    for attempt in range(attempts):
        body = get(transport, url, params, attempts, pause, sleep)
        try:
            return parse(body)
        except FormatError:
            if attempt + 1 == attempts:
                raise
            sleep(pause * 2**attempt)
    raise TransportError(f"{url}: no attempts were allowed")


def parsed_json(body: str) -> Any:
    try:
        return json.loads(body)
    except ValueError as e:
        raise FormatError(f"the body is no JSON: {e}") from e


def page_count(first_page: str, page_size: int) -> int:
    """Pages of a service that states ``_meta.total``; at least one."""
    try:
        total = json.loads(first_page)["_meta"]["total"]
    except (ValueError, KeyError, TypeError) as e:
        raise FormatError("the first page does not state a total") from e
    return max(1, -(-int(total) // page_size))


class _Part(InputPartition):
    """A page or chunk; the first page comes with its body, which was needed to count the pages."""

    def __init__(self, number: int, params: dict[str, str], body: str | None = None, about: str | None = None):
        super().__init__(number)
        self.number, self.params, self.body, self.about = number, params, body, about


def sound_json(body: str) -> str:
    """The body, if it is JSON."""
    parsed_json(body)
    return body


class PagedJson(DataSource):
    """``page int, body string`` of each page of a service, one task per page; pages without items are left out.

    Options: ``url``, ``page_size`` and any query parameters as ``param.<name>``.  Register with ``spark.dataSource.register``.  Subclasses may give
    another ``transport()``, which must be usable in a task.
    """

    @classmethod
    def name(cls) -> str:
        return "paged_json"

    def schema(self) -> str:
        return "page int, body string"

    def transport(self) -> Transport:
        return UrlTransport()

    def reader(self, schema: Any) -> DataSourceReader:
        return _PagedReader(self.transport(), dict(self.options))


class _PagedReader(DataSourceReader):
    def __init__(self, transport: Transport, options: dict[str, str]):
        self._transport, self._url = transport, options["url"]
        self._size = int(options.get("page_size", 2000))
        self._params = {k[6:]: v for k, v in options.items() if k.startswith("param.")}

    def _of(self, page: int) -> dict[str, str]:
        return self._params | {"page": str(page), "max_results": str(self._size)}

    def partitions(self) -> list[InputPartition]:
        number, first = get_parsed(self._transport, self._url, self._of(1), lambda body: (page_count(body, self._size), body))
        return [_Part(n + 1, self._of(n + 1), first if n == 0 else None) for n in range(number)]

    def read(self, partition: InputPartition) -> Iterator[tuple[int, str]]:
        assert isinstance(partition, _Part)
        body = partition.body if partition.body is not None else get_parsed(self._transport, self._url, partition.params, sound_json)
        page = json.loads(body)
        if not isinstance(page, dict) or page.get("_items") != []:
            yield partition.number, body


class ChunkedWeather(PagedJson):
    """``body string, asked string``: hourly weather of locations, a request and task for each ``chunk`` of them.

    Options: ``url``, ``locations`` (a JSON list of ``location_id, latitude, longitude``), ``start``, ``end``, ``hourly``, ``chunk``.
    """

    @classmethod
    def name(cls) -> str:
        return "chunked_weather"

    def schema(self) -> str:
        return "body string, asked string"

    def reader(self, schema: Any) -> DataSourceReader:
        return _WeatherReader(self.transport(), dict(self.options))


class _WeatherReader(DataSourceReader):
    def __init__(self, transport: Transport, options: dict[str, str]):
        self._transport, self._options = transport, options

    def partitions(self) -> list[InputPartition]:
        o, locations = self._options, json.loads(self._options["locations"])
        size = int(o.get("chunk", 10))
        fixed = {"start_date": o["start"], "end_date": o["end"], "hourly": o["hourly"], "wind_speed_unit": "ms", "timezone": "GMT"}
        parts: list[InputPartition] = []
        for begin in range(0, len(locations), size):
            chunk = locations[begin : begin + size]
            at = {name: ",".join(str(place[name]) for place in chunk) for name in ("latitude", "longitude")}
            parts.append(_Part(begin // size, at | fixed, about=json.dumps(chunk)))
        return parts

    def read(self, partition: InputPartition) -> Iterator[tuple[str, str]]:
        assert isinstance(partition, _Part)
        yield get_parsed(self._transport, self._options["url"], partition.params, sound_json), partition.about or "[]"
