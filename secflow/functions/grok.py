"""Grok patterns compiled on the driver to plain Java regexes that run once per row in the JVM."""

from __future__ import annotations

import re
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

from secflow.functions.text import clean_map

# The pattern library, one "NAME pattern" per line.
COMMON_PATTERNS = r"""
USERNAME [a-zA-Z0-9._-]+
INT (?:[+-]?(?:[0-9]+))
POSINT \b(?:[1-9][0-9]*)\b
WORD \b\w+\b
DATA .*?
GREEDYDATA .*
QUOTEDSTRING (?>(?<!\\)(?>"(?>\\.|[^\\"]+)+"|""|(?>'(?>\\.|[^\\']+)+')|''|(?>`(?>\\.|[^\\`]+)+`)|``))
IPV6 ((([0-9A-Fa-f]{1,4}:){7}([0-9A-Fa-f]{1,4}|:))|(([0-9A-Fa-f]{1,4}:){6}(:[0-9A-Fa-f]{1,4}|((25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)(\.(25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)){3})|:))|(([0-9A-Fa-f]{1,4}:){5}(((:[0-9A-Fa-f]{1,4}){1,2})|:((25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)(\.(25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)){3})|:))|(([0-9A-Fa-f]{1,4}:){4}(((:[0-9A-Fa-f]{1,4}){1,3})|((:[0-9A-Fa-f]{1,4})?:((25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)(\.(25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)){3}))|:))|(([0-9A-Fa-f]{1,4}:){3}(((:[0-9A-Fa-f]{1,4}){1,4})|((:[0-9A-Fa-f]{1,4}){0,2}:((25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)(\.(25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)){3}))|:))|(([0-9A-Fa-f]{1,4}:){2}(((:[0-9A-Fa-f]{1,4}){1,5})|((:[0-9A-Fa-f]{1,4}){0,3}:((25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)(\.(25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)){3}))|:))|(([0-9A-Fa-f]{1,4}:){1}(((:[0-9A-Fa-f]{1,4}){1,6})|((:[0-9A-Fa-f]{1,4}){0,4}:((25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)(\.(25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)){3}))|:))|(:(((:[0-9A-Fa-f]{1,4}){1,7})|((:[0-9A-Fa-f]{1,4}){0,5}:((25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)(\.(25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)){3}))|:)))(%.+)?
IPV4 (?<![0-9])(?:(?:25[0-5]|2[0-4][0-9]|[0-1]?[0-9]{1,2})[.](?:25[0-5]|2[0-4][0-9]|[0-1]?[0-9]{1,2})[.](?:25[0-5]|2[0-4][0-9]|[0-1]?[0-9]{1,2})[.](?:25[0-5]|2[0-4][0-9]|[0-1]?[0-9]{1,2}))(?![0-9])
IP (?:%{IPV6}|%{IPV4})
HOSTNAME \b(?:[0-9A-Za-z_][0-9A-Za-z-_]{0,62})(?:\.(?:[0-9A-Za-z_][0-9A-Za-z-_]{0,62}))*(\.?|\b)
IPORHOST (?:%{HOSTNAME}|%{IP})
MONTH \b(?:Jan(?:uary)?|Feb(?:ruary)?|Mar(?:ch)?|Apr(?:il)?|May|Jun(?:e)?|Jul(?:y)?|Aug(?:ust)?|Sep(?:tember)?|Oct(?:ober)?|Nov(?:ember)?|Dec(?:ember)?)\b
MONTHNUM (?:0?[1-9]|1[0-2])
MONTHDAY (?:(?:0[1-9])|(?:[12][0-9])|(?:3[01])|[1-9])
YEAR (?>\d\d){1,2}
HOUR (?:2[0123]|[01]?[0-9])
MINUTE (?:[0-5][0-9])
SECOND (?:(?:[0-5]?[0-9]|60)(?:[:.,][0-9]+)?)
TIME (?!<[0-9])%{HOUR}:%{MINUTE}(?::%{SECOND})(?![0-9])
ISO8601_TIMEZONE (?:Z|[+-]%{HOUR}(?::?%{MINUTE}))
TIMESTAMP_ISO8601 %{YEAR}-%{MONTHNUM}-%{MONTHDAY}[T ]%{HOUR}:?%{MINUTE}(?::?%{SECOND})?%{ISO8601_TIMEZONE}?
TZ (?:[A-Z]{1,5})
"""

ASA_PATTERNS = r"""
CISCO_TIMESTAMP %{MONTH:month} +%{MONTHDAY:day}(?: %{YEAR:year})? %{TIME:time}( %{TZ:timezone})?
CISCO_BEGIN ( )?(<%{INT}>)?(%{INT})?(:)?( )?
CISCO_MAYBE_IP ( %{IP})?( )?(:)?
CISCO_SOURCE_IMP_ID %%{WORD:eventSourceSubsys}(-auth|-sys|-config|-session|-vpnc)?-%{INT:interactionImportance}
CISCO_HEAD %{CISCO_BEGIN}%{CISCO_TIMESTAMP:originTime}%{CISCO_MAYBE_IP} (:)?%{CISCO_SOURCE_IMP_ID}-%{INT:datapayloadMsgId}
CISCO_USER_OR_STARS %{WORD}|\*{5}
CISCO_USER user = %{CISCO_USER_OR_STARS:subjectName}
CISCO_WORD \b[\w\-]+\b
CISCOASA_ID %(%{WORD})(-auth|-sys|-config|-session|-vpnc)?-%{INT}-%{INT:id}
CISCOASA_113004 %{CISCO_HEAD}: AAA user (authentication|accounting) Successful : server =  %{IPORHOST:aux1} : %{CISCO_USER}
CISCOASA_113012 %{CISCO_HEAD}: AAA user authentication Successful : local database : %{CISCO_USER}
CISCOASA_113015 %{CISCO_HEAD}: AAA user authentication Rejected : reason = %{GREEDYDATA:interactionReason} : local database : %{CISCO_USER}( : user IP = %{IP:sourceLocationIp})?
CISCOASA_605005 %{CISCO_HEAD}: Login permitted from ((serial to console)|%{IP:sourceLocationIp}/%{INT:sourceLocationPort} to %{WORD}:%{IP:destinationLocationIp}/%{WORD:aux10}) for user "%{CISCO_USER_OR_STARS:subjectName}"
CISCOASA_611101 %{CISCO_HEAD}: User authentication succeeded: Uname: %{CISCO_USER_OR_STARS:subjectName}
CISCOASA_111008 %{CISCO_HEAD}: User '%{CISCO_USER_OR_STARS:subjectName}' executed the '%{GREEDYDATA:command}' command.
CISCOASA_111010 %{CISCO_HEAD}: User '%{CISCO_USER_OR_STARS:subjectName}', running '%{GREEDYDATA}' from IP %{IP:sourceLocationIp}, executed '%{GREEDYDATA:command}'
CISCOASA_106023 %{CISCO_BEGIN}%{CISCO_TIMESTAMP:originTime}%{CISCO_MAYBE_IP}( Abc-ASA)? (:)?( )?%{CISCO_SOURCE_IMP_ID}-%{INT:datapayloadMsgId}: Deny (protocol )?%{WORD:interactionProtocol}? src %{CISCO_WORD:dataPayloadInterface}:%{IPORHOST:sourceLocationIp}(/%{INT:sourceLocationPort})? dst %{CISCO_WORD:aux1}:%{IPORHOST:destinationLocationIp}(/%{INT:destinationLocationPort})?(%{GREEDYDATA})?( \(type %{INT}, code %{INT}\))? by access-group "%{CISCO_WORD:aux10}"
CISCOASA_710003 %{CISCO_BEGIN}%{CISCO_TIMESTAMP:originTime}( %{CISCO_WORD:t})? : %{CISCO_SOURCE_IMP_ID}-%{INT:datapayloadMsgId}: %{WORD:interactionProtocol} access denied by ACL from %{IPORHOST:sourceLocationIp}(/%{INT:sourceLocationPort})? to outside:%{IPORHOST:destinationLocationIp}(/%{INT:destinationLocationPort})
CISCOASA_104001 %{CISCO_HEAD}: \(Secondary\) Switching to ACTIVE - %{GREEDYDATA:interactionReason}
CISCOASA_104002 %{CISCO_HEAD}: \(Primary\) Switching to STNDBY - %{GREEDYDATA:interactionReason}
CISCOASA_105005 %{CISCO_HEAD}: \(Secondary\) %{GREEDYDATA:interactionReason}
CISCOASA_105008 %{CISCO_HEAD}:
CISCOASA_105009 %{CISCO_HEAD}: \(%{USERNAME}\) Testing on (i|I)nterface %{WORD:objectValue}( Status)? %{WORD:interactionStatus}
CISCOASA_106001 %{CISCO_BEGIN}%{CISCO_TIMESTAMP:originTime}( %{USERNAME} )?%{CISCO_MAYBE_IP} (:)?%{CISCO_SOURCE_IMP_ID}-%{INT:datapayloadMsgId}: Inbound TCP connection denied from %{IP:sourceLocationIp}/%{INT:sourceLocationPort} to %{IP:destinationLocationIp}/%{INT:destinationLocationPort} flags %{GREEDYDATA} on interface %{USERNAME:objectName}
CISCOASA_106006 %{CISCO_BEGIN}%{CISCO_TIMESTAMP:originTime}( %{USERNAME} )?%{CISCO_MAYBE_IP} (:)?%{CISCO_SOURCE_IMP_ID}-%{INT:datapayloadMsgId}: Deny inbound UDP from %{IP:sourceLocationIp}/%{INT:sourceLocationPort} to %{IP:destinationLocationIp}/%{INT:destinationLocationPort} on interface %{USERNAME:objectName}
CISCOASA_106007 %{CISCO_BEGIN}%{CISCO_TIMESTAMP:originTime}( %{USERNAME} )?%{CISCO_MAYBE_IP} (:)?%{CISCO_SOURCE_IMP_ID}-%{INT:datapayloadMsgId}: Deny inbound UDP from %{IP:sourceLocationIp}/%{INT:sourceLocationPort} to %{IP:destinationLocationIp}/%{INT:destinationLocationPort}
CISCOASA_106011 %{CISCO_BEGIN}%{CISCO_TIMESTAMP:originTime}( %{USERNAME} )?%{CISCO_MAYBE_IP} (:)?%{CISCO_SOURCE_IMP_ID}-%{INT:datapayloadMsgId}: Deny inbound \(No xlate\) %{WORD:interactionProtocol} src %{USERNAME:objectName}:%{IP:sourceLocationIp}(/%{INT:sourceLocationPort})? dst %{USERNAME:subjectName}:%{IP:destinationLocationIp}(/%{INT:destinationLocationPort})?( \(%{GREEDYDATA:aux4}, %{GREEDYDATA:aux5}\))?
CISCOASA_106014 %{CISCO_BEGIN}%{CISCO_TIMESTAMP:originTime}( %{USERNAME} )?%{CISCO_MAYBE_IP} (:)?%{CISCO_SOURCE_IMP_ID}-%{INT:datapayloadMsgId}: Deny inbound %{WORD:objectName} src %{USERNAME}:%{IP:sourceLocationIp}(/%{INT:sourceLocationPort})? dst %{USERNAME}:%{IP:destinationLocationIp}(/%{INT:destinationLocationPort})?( \(%{GREEDYDATA:aux4}, %{GREEDYDATA:aux5}\))?
"""

IOS_PATTERNS = r"""
CISCO_IOS_ISR_HEADER %{USERNAME}-%{POSINT:importance}-%{USERNAME:eventType}
CISCO_IOS_ISR_LOGIN \%%{CISCO_IOS_ISR_HEADER:msgId}: %{GREEDYDATA} \[user: %{USERNAME:subjectName}?\] \[source: %{IP:sourceIp}\] \[localport: %{INT:destinationPort}\]( \[reason: %{GREEDYDATA:interactionReason}\])? at %{TIME:time} %{WORD:timezone} %{WORD} %{WORD:month} %{INT:day} %{YEAR:year}
CISCO_IOS_ISR_SSH2 %{WORD:month} %{INT:day} %{TIME:time} %{WORD:timezone}: \%%{CISCO_IOS_ISR_HEADER:msgId}: user '(%{USERNAME:subjectName})?' authentication for ssh2 session from %{IP:sourceIp} %{GREEDYDATA} %{WORD:status}
CISCO_IOS_ISR_LOGOUT %{WORD:month} %{INT:day} %{TIME:time} %{WORD:timezone}: \%%{CISCO_IOS_ISR_HEADER:msgId}: user %{USERNAME:subjectName} has exited tty session %{INT}\(%{IP:sourceIp}\)
CISCO_IOS_ISR_CONFIG_I %{WORD:month} ( )?%{INT:day} %{TIME:time}( %{WORD:timezone})?: \%%{CISCO_IOS_ISR_HEADER:msgId}: (r%{INT}/%{INT}: %{WORD:objectName}: )?configured from %{GREEDYDATA:aux1} by (%{USERNAME:subjectName}( on|,) %{USERNAME})?( \(%{IP:sourceIp}\))?( %{INT:aux2})?
"""

AUDIT_PATTERNS = r"""
AUDITD_TIMESTAMP %{INT:msg_timestamp}.%{INT}
AUDITD_HEADER audit\(%{AUDITD_TIMESTAMP}:%{INT:msg_id}\)
AUDITD_AVC_INTERACTION_STATUS (denied|granted)
AUDITD_AVC type=AVC msg=%{AUDITD_HEADER}: avc:( +)?%{AUDITD_AVC_INTERACTION_STATUS:interaction_status}%{DATA}name=%{QUOTEDSTRING} %{GREEDYDATA:aux8}
"""

ANTIVIRUS_PATTERNS = r"""
ESET_USER_AND_DOMAIN %{GREEDYDATA:parsed_domain}\\%{GREEDYDATA:parsed_username}
ESET_AUDIT_EVENT %{GREEDYDATA}'%{USERNAME:parsed_username}'
"""

FAIL2BAN_PATTERNS = r"""
FAIL_2_BAN %{TIMESTAMP_ISO8601:originTime} %{USERNAME:msgId}%{GREEDYDATA}: %{WORD:importance} +\[%{USERNAME:aux1}\] %{WORD:aux2} %{IP:sourceIp}
"""

REASSEMBLY_PATTERNS = r"""
TIMESTAMP %{INT}.%{INT}
REASSEMBLY_HEADER audit\(%{TIMESTAMP:timestamp}:%{INT:id}\)
"""

# Cannot occur in a text log, so it can separate captured values.
FIELD_MARK = "\x01"
REFERENCE = re.compile(r"%\{(\w+)(?::(\w+))?\}")


def library(*sources: str) -> dict[str, str]:
    lines = (line for source in sources for line in source.strip("\n").split("\n"))
    return dict(line.split(" ", 1) for line in lines if line)


LIBRARY = library(
    COMMON_PATTERNS, ASA_PATTERNS, IOS_PATTERNS, AUDIT_PATTERNS, ANTIVIRUS_PATTERNS,
    FAIL2BAN_PATTERNS, REASSEMBLY_PATTERNS,
)


@lru_cache(maxsize=256)
def _compile(pattern: str, known: tuple[tuple[str, str], ...]) -> tuple[str, tuple[str, ...]]:
    patterns = dict(known)
    captured: list[str] = []

    def expand(text: str) -> str:
        def reference(match: re.Match) -> str:
            name, field = match.groups()
            if name not in patterns:
                raise KeyError(f"grok pattern {name} is not defined")
            if field is None:
                return "(?:" + expand(patterns[name]) + ")"
            captured.append(field)
            group = f"f{len(captured) - 1}"
            return f"(?<{group}>" + expand(patterns[name]) + ")"

        return REFERENCE.sub(reference, text)

    return expand(pattern), tuple(captured)


def compile_grok(pattern: str, patterns: dict[str, str] | None = None) -> tuple[str, list[str]]:
    """Expand ``%{NAME:field}`` references to one Java regex and the list of its fields.

    Group ``f0``, ``f1``, … of the regex belongs to the field of the same position.
    """
    regex, fields = _compile(pattern, tuple((patterns or LIBRARY).items()))
    return regex, list(fields)


def grok_values(text: Column, pattern: str, patterns: dict[str, str] | None = None):
    """Captured texts as an array in field order, NULL when the pattern does not occur.

    The whole text is rewritten to the captured groups in one pass, so the regex runs once
    per row no matter how many fields it has.
    """
    regex, fields = compile_grok(pattern, patterns)
    # A sender's own mark would shift the fields or feign a match; it becomes a blank.
    rewritten = F.regexp_replace(
        F.translate(text, FIELD_MARK, " "),
        F.lit(r"^[\s\S]*?(?:" + regex + r")[\s\S]*$"),
        F.lit(FIELD_MARK + FIELD_MARK.join(f"${{f{i}}}" for i in range(len(fields)))),
    )
    values = F.split(F.substr(rewritten, F.lit(2)), FIELD_MARK)
    return F.when(F.startswith(rewritten, F.lit(FIELD_MARK)), values), fields


def parse_grok(text: Column, pattern: str, patterns: dict[str, str] | None = None) -> Column:
    """Map of captured fields, trimmed and without null synonyms; an empty map when nothing matches."""
    values, fields = grok_values(text, pattern, patterns)
    if len(set(fields)) == len(fields):
        names = F.split(F.lit(",".join(fields)), ",")
        entries = F.when(values.isNotNull(), F.map_from_arrays(names, values))
    else:
        # A field named twice keeps the value of its first group that took part in the match.
        distinct = list(dict.fromkeys(fields))
        first = [
            F.coalesce(*[
                F.when(F.get(values, F.lit(i)) != "", F.get(values, F.lit(i)))
                for i, field in enumerate(fields) if field == name
            ])
            for name in distinct
        ]
        entries = F.map_from_arrays(F.array(*map(F.lit, distinct)), F.array(*first))
    return F.coalesce(clean_map(entries), F.create_map().cast("map<string,string>"))
