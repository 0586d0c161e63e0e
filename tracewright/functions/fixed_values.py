"""Vocabularies, lookup tables and patterns that the log formats and
the label, mapping and enrichment rules prescribe. Results depend on each of them,
so they are stated plainly, all in this place."""

# Canonical vocabularies ---------------------------------------
SEVERITY = {
    "emerg": 10,
    "alert": 8,
    "crit": 8,
    "critical": 8,
    "err": 6,
    "error": 6,
    "warning": 4,
    "warn": 4,
    "notice": 2,
    "info": 1,
    "informational": 1,
    "debug": 1,
    "high": 6,
    "medium": 4,
    "low": 2,
    "unknown": 0,
    "1": 6,
    "2": 4,
    "3": 2,
    "0": 1,
    "4": 4,
    "6": 6,
    "8": 8,
    "10": 10,
}
ACTION = {
    "allow": "allow",
    "permitted": "allow",
    "accept": "allow",
    "deny": "deny",
    "denied": "deny",
    "block": "block",
    "blocked": "block",
    "drop": "drop",
    "dropped": "drop",
    "alert": "alert",
    "reset": "reset",
    "teardown": "drop",
}
CATEGORY = {
    "network": "network",
    "firewall": "network",
    "ids": "threat",
    "ips": "threat",
    "intrusion": "threat",
    "threat": "threat",
    "auth": "authentication",
    "authentication": "authentication",
    "login": "authentication",
    "policy": "policy",
    "system": "system",
}
DEVICE = {
    "firewall": "firewall",
    "ids": "ids_ips",
    "ips": "ids_ips",
    "ids_ips": "ids_ips",
    "proxy": "proxy",
    "router": "router_switch",
    "switch": "router_switch",
    "vpn": "vpn",
    "waf": "web_application_firewall",
    "endpoint": "endpoint",
    "generic": "generic",
}
#: Canonical severity to the one of a CEF header.
CEF_SEVERITY = {0: 0, 1: 1, 2: 3, 4: 5, 6: 7, 8: 9, 10: 10}

# What the dashboard takes for a threat ------------------------
THREAT_LABELS = ["critical", "high", "medium", "alert", "emergency", "warning", "warn"]
THREAT_ACTIONS = ["deny", "block", "drop", "alert", "quarantine", "reject", "reset"]
THREAT_WORDS = ["attack", "malicious", "threat"]
NO_THREAT_NAMES = ["-", "None", "unknown", ""]

# Techniques in order; (pattern, tactic, technique, name) ------
TECHNIQUES = [
    (r"sql\s*injection|\bsqli\b|or\s+1\s*=\s*1|union\s+select|path\s*traversal|\.\./|\bxss\b|cross[- ]site\s*script|apache\s*path|web[- ]attack|remote\s*code\s*execution|\brce\b", "Initial Access", "T1190", "Exploit Public-Facing Application"),
    (r"brute\s*force|failed\s*logon|login\s*failure|eventid\s*4625|password\s*spray|credential\s*stuffing|auth_failed|auth\s*failure", "Credential Access", "T1110", "Brute Force"),
    (r"port\s*scan|\bscan\b|reconnaissance|shodan|masscan|service\s*discovery|icmp\s*ping|host\s*sweep|\bprobe\b", "Discovery", "T1046", "Network Service Discovery"),
    (r"cmd\.php|powershell|cmd\.exe|/bin/sh|/bin/bash|command\s*injection|script\s*interpreter|reverse\s*shell", "Execution", "T1059", "Command and Scripting Interpreter"),
    (r"\bc2\b|command\s*and\s*control|trojan|botnet|dns\s*tunnel|beacon|cobalt\s*strike|mirai", "Command and Control", "T1071", "Application Layer Protocol"),
    (r"denial\s*of\s*service|dos|ddos|syn\s*flood|udp\s*flood|bandwidth\s*exhaust", "Impact", "T1498", "Network Denial of Service"),
    (r"createaccesskey|accessdenied|assume_role|privilege\s*escalation|unauthorized_api", "Privilege Escalation", "T1078", "Valid Accounts"),
]

# Weak labels ---------------------------------------------------
SCANNERS = ["gobuster", "dirbuster", "nmap scripting engine", "zgrab", "sqlmap", "nikto", "masscan", "nuclei", "wpscan", "ffuf"]
BROWSERS = ["Mozilla/", "Opera/"]
PAYLOADS = {
    "payload_shell": r"(?:rm(?:_|\s)+-rf|(?:wget|curl)(?:_|\s)+[^;|&]*(?:;|%3b)(?:_|\s)*(?:sh|bash))",
    "payload_traversal": r"(?:\.\./|%2e%2e(?:%2f|/))",
    "payload_sqli": r"(?:union(?:_|\s)+select|(?:%27|')(?:_|\s)*(?:or|and)(?:_|\s)+\d+(?:_|\s)*=(?:_|\s)*\d+)",
    "payload_xss": r"(?:<script|%3cscript)",
}

# Cisco ASA -----------------------------------------------------
SYSLOG_LEVELS = ["emergency", "alert", "critical", "error", "warning", "notice", "informational", "debug"]
#: Numeric severity of each syslog level, in their order.
SYSLOG_SCORES = [10, 9, 8, 7, 6, 5, 4, 2]
ASA_DENY = r"\b(deny|denied|drop|block|reject|teardown)\b"
ASA_ALLOW = r"\b(permit|allow|built|established|translated)\b"
ASA_NAMES = {
    "106": "ACL Deny",
    "302": "NAT/Connection",
    "305": "Dynamic Translation",
    "710": "Access Denied",
    "719": "AAA Failure",
    "733": "Rate Limit Exceeded",
    "407": "No Route to Host",
    "313": "ICMP Unreachable",
    "402": "IKE/IPsec Error",
    "609": "Local Host Removed",
}

# PAN-OS --------------------------------------------------------
PAN_ACTION = {
    "allow": "allow",
    "deny": "deny",
    "drop": "drop",
    "reset-client": "reset",
    "reset-server": "reset",
    "reset-both": "reset",
    "block-url": "block",
    "block-ip": "block",
    "sinkhole": "block",
}
PAN_SUBTYPE = {"start": "allow", "end": "allow", "drop": "drop", "deny": "deny"}
PAN_SEVERITY = {"critical": "critical", "high": "high", "medium": "medium", "low": "low", "informational": "informational", "info": "informational"}

# CEF, LEEF and syslog field names ------------------------------
CEF_KEYS = {
    "src": "src_ip",
    "shost": "src_ip",
    "dst": "dst_ip",
    "dhost": "dst_ip",
    "spt": "src_port",
    "dpt": "dst_port",
    "proto": "protocol",
    "act": "action",
    "outcome": "event_action",
    "request": "http_url",
    "requestMethod": "http_method",
    "requestClientApplication": "user_agent",
    "suser": "username",
    "duser": "username",
    "msg": "message",
    "reason": "message",
}
LEEF_KEYS = {
    "src": "src_ip",
    "dst": "dst_ip",
    "spt": "src_port",
    "dpt": "dst_port",
    "proto": "protocol",
    "usrName": "username",
    "url": "http_url",
    "ua": "user_agent",
    "devTime": "timestamp_raw",
    "cat": "event_category",
    "msg": "message",
    "sev": "severity",
    "severity": "severity",
    "action": "action",
    "vSrcPort": "src_port",
    "vDstPort": "dst_port",
}
SYSLOG_KEYS = {
    "src": "src_ip",
    "source": "src_ip",
    "sip": "src_ip",
    "dst": "dst_ip",
    "dest": "dst_ip",
    "dip": "dst_ip",
    "spt": "src_port",
    "sport": "src_port",
    "srcport": "src_port",
    "dpt": "dst_port",
    "dport": "dst_port",
    "dstport": "dst_port",
    "proto": "protocol",
    "protocol": "protocol",
    "action": "event_action",
    "act": "event_action",
    "user": "username",
    "usrname": "username",
    "suser": "username",
    "url": "http_url",
    "request": "http_url",
    "method": "http_method",
}
SYSLOG_ACTIONS = r"\b(deny|denied|allow|allowed|accept|accepted|drop|dropped|block|blocked|reject|rejected|pass)\b"

# Snort priorities ----------------------------------------------
SNORT_PRIORITY = {"1": "high", "2": "medium", "3": "low", "4": "informational"}

# CloudTrail ----------------------------------------------------
TRAIL_ERRORS = {
    "AccessDenied": "deny",
    "UnauthorizedOperation": "deny",
    "AuthFailure": "deny",
    "InvalidClientTokenId": "deny",
    "NoCredentialProviders": "deny",
}
TRAIL_HIGH_ERRORS = ["AccessDenied", "UnauthorizedOperation", "AuthFailure"]
TRAIL_THREAT_ERRORS = ["AccessDenied", "UnauthorizedOperation"]
TRAIL_HIGH = ["Delete", "Remove", "Revoke", "Detach", "Terminate", "Stop", "Disable", "Deregister", "Unauthorize"]
TRAIL_MEDIUM = ["Create", "Put", "Add", "Attach", "Authorize", "Enable", "Modify", "Update", "Set", "Associate"]

# Windows events by EventID --------------------------------------
WINDOWS_NAMES = {
    "4624": "Successful Logon",
    "4625": "Failed Logon",
    "4634": "Logoff",
    "4647": "User Initiated Logoff",
    "4648": "Logon With Explicit Credentials",
    "4672": "Special Privileges Assigned",
    "4688": "Process Created",
    "4698": "Scheduled Task Created",
    "4700": "Scheduled Task Enabled",
    "4702": "Scheduled Task Updated",
    "4720": "User Account Created",
    "4722": "User Account Enabled",
    "4724": "Password Reset Attempt",
    "4725": "User Account Disabled",
    "4726": "User Account Deleted",
    "4740": "User Account Locked Out",
    "4756": "Member Added to Security Group",
    "4768": "Kerberos TGT Requested",
    "4769": "Kerberos Service Ticket Requested",
    "4776": "NTLM Authentication",
    "5140": "Network Share Accessed",
    "5156": "Windows Filtering Platform Connection Permitted",
    "5157": "Windows Filtering Platform Connection Blocked",
}
WINDOWS_ACTION = {"4624": "allow", "4625": "deny", "4648": "allow", "5156": "allow", "5157": "deny", "4740": "block"}
WINDOWS_SEVERITY = {"4625": "medium", "4740": "high", "4688": "low", "4720": "medium", "4726": "medium", "5157": "medium"}

# Names of generic XML elements and attributes -------------------
XML_KEYS = {
    "srcip": "src_ip",
    "sourceip": "src_ip",
    "src_ip": "src_ip",
    "source_ip": "src_ip",
    "dstip": "dst_ip",
    "destip": "dst_ip",
    "destinationip": "dst_ip",
    "dst_ip": "dst_ip",
    "destination_ip": "dst_ip",
    "srcport": "src_port",
    "sourceport": "src_port",
    "src_port": "src_port",
    "dstport": "dst_port",
    "destport": "dst_port",
    "dst_port": "dst_port",
    "protocol": "protocol",
    "proto": "protocol",
    "action": "event_action",
    "severity": "severity",
    "level": "severity",
    "username": "username",
    "user": "username",
    "hostname": "device_hostname",
    "host": "device_hostname",
    "computer": "device_hostname",
    "message": "threat_name",
    "msg": "threat_name",
    "eventid": "threat_signature_id",
    "event_id": "threat_signature_id",
    "timestamp": "timestamp_raw",
    "time": "timestamp_raw",
    "datetime": "timestamp_raw",
    "useragent": "user_agent",
    "user_agent": "user_agent",
    "url": "http_url",
    "uri": "http_url",
}

# Networks in order; (network, country, city, operator) ---------
NETWORKS = [
    ("8.8.8.0/24", "US", "Mountain View", "AS15169 Google LLC"),
    ("8.8.4.0/24", "US", "Mountain View", "AS15169 Google LLC"),
    ("1.1.1.0/24", "US", "San Francisco", "AS13335 Cloudflare Inc"),
    ("1.0.0.0/24", "US", "San Francisco", "AS13335 Cloudflare Inc"),
    ("9.9.9.0/24", "CH", "Zurich", "AS19281 Quad9"),
    ("208.67.222.0/24", "US", "San Francisco", "AS36692 Cisco OpenDNS"),
    ("208.67.220.0/24", "US", "San Francisco", "AS36692 Cisco OpenDNS"),
    ("172.217.0.0/16", "US", "Mountain View", "AS15169 Google LLC"),
    ("142.250.0.0/15", "US", "Mountain View", "AS15169 Google LLC"),
    ("34.0.0.0/11", "US", "Council Bluffs", "AS15169 Google Cloud"),
    ("35.192.0.0/12", "US", "Council Bluffs", "AS15169 Google Cloud"),
    ("52.0.0.0/11", "US", "Ashburn", "AS16509 Amazon.com Inc"),
    ("54.0.0.0/11", "US", "Ashburn", "AS16509 Amazon.com Inc"),
    ("3.0.0.0/9", "US", "Seattle", "AS16509 Amazon AWS"),
    ("18.0.0.0/9", "US", "Seattle", "AS16509 Amazon AWS"),
    ("13.64.0.0/11", "US", "Redmond", "AS8075 Microsoft Corp"),
    ("20.0.0.0/11", "US", "Redmond", "AS8075 Microsoft Azure"),
    ("40.64.0.0/10", "US", "Redmond", "AS8075 Microsoft Azure"),
    ("104.16.0.0/12", "US", "San Francisco", "AS13335 Cloudflare CDN"),
    ("172.64.0.0/13", "US", "San Francisco", "AS13335 Cloudflare CDN"),
    ("45.33.32.0/24", "US", "Atlanta", "AS63949 Linode LLC"),
    ("198.51.100.0/24", "US", "External WAN", "AS64496 Documentation-NET-2"),
    ("203.0.113.0/24", "US", "External DMZ", "AS64497 Documentation-NET-3"),
    ("192.0.2.0/24", "US", "External Gateway", "AS64498 Documentation-NET-1"),
    ("185.0.0.0/8", "DE", "Frankfurt", "AS3320 Deutsche Telekom AG"),
    ("193.0.0.0/8", "NL", "Amsterdam", "AS1103 SURFnet bv"),
    ("194.0.0.0/8", "FR", "Paris", "AS3215 Orange S.A."),
    ("82.0.0.0/8", "GB", "London", "AS2856 British Telecom"),
    ("86.0.0.0/8", "GB", "Manchester", "AS5089 Virgin Media"),
    ("103.0.0.0/8", "IN", "Mumbai", "AS4755 Bharti Airtel Ltd"),
    ("106.0.0.0/8", "IN", "New Delhi", "AS9829 BSNL Internet"),
    ("117.0.0.0/8", "IN", "Bangalore", "AS55836 Reliance Jio"),
    ("122.0.0.0/8", "IN", "Chennai", "AS4755 Bharti Airtel Ltd"),
    ("49.0.0.0/8", "IN", "Hyderabad", "AS55836 Reliance Jio"),
    ("110.0.0.0/8", "CN", "Beijing", "AS4134 China Telecom"),
    ("111.0.0.0/8", "CN", "Shanghai", "AS9808 China Mobile"),
    ("112.0.0.0/8", "CN", "Guangzhou", "AS4837 China Unicom"),
    ("123.0.0.0/8", "CN", "Shenzhen", "AS4134 China Telecom"),
]
#: (country, city, operator, first octets) of addresses outside the networks.
REGIONS = [
    ("IN", "India Regional", "AS-APNIC Regional", [103, 106, 115, 117, 122, 49]),
    ("CN", "China Regional", "AS-APNIC Regional", [110, 111, 112, 113, 123, 220]),
    ("EU", "Europe Regional", "AS-RIPE Regional", [185, 188, 193, 194, 195, 212, 213, 217]),
    ("US", "North America", "AS-ARIN Regional", [3, 12, 13, 15, 16, 17, 18, 20, 24, 32, 34, 35, 40, 44, 45, 50, 52, 54, 63, 64, 65, 66, 67, 68, 69, 70, 71, 72, 73, 74, 75, 76, 96, 97, 98, 99]),
]

# Addresses and networks of threat lists; (list, score) ---------
THREATS = {
    "198.51.100.44": ("tor_exit_nodes", 0.95),
    "198.51.100.77": ("emerging_threats_botnet", 0.90),
    "203.0.113.88": ("darklist_c2", 0.98),
    "203.0.113.120": ("mirai_scanner", 0.85),
    "45.33.32.156": ("shodan_scanner", 0.75),
    "198.51.100.12": ("web_attack_botnet", 0.92),
    "203.0.113.14": ("apt_active_threat", 0.99),
    "198.51.100.95": ("bruteforce_botnet", 0.88),
    "198.51.100.110": ("compromised_iam_recon", 0.80),
    "203.0.113.250": ("ransomware_c2", 1.00),
    "185.220.101.5": ("tor_exit_nodes", 0.95),
    "185.220.102.8": ("tor_exit_nodes", 0.95),
    "89.248.165.10": ("masscan_recon", 0.70),
}
THREAT_NETS = [("198.51.100.64/28", "emerging_threats_bruteforce", 0.88), ("203.0.113.80/28", "darklist_c2_pool", 0.95)]

# The shapes of log lines; groups are numbered in the order of the fields --
CEF_LINE = r"(?s)^.*?CEF:(\d+)" + r"\|([^|]*)" * 6 + r"\|(.*)$"
CEF_PAIR = r"(?U)(\w+)=(.*?)(?=\s+\w+=|$)"
LEEF_LINE = r"(?s)^LEEF:(\d+\.\d+)" + r"\|([^|]*)" * 4 + r"(?:\|delimiter=([^|]+))?\|(.*)$"
SNORT_LINE = (
    r"(?i)^(\d{2}/\d{2}(?:/\d{4})?-\d{2}:\d{2}:\d{2}[.\d]*)\s+(?:\[([^\]]+)\]\s+)?\[\*\*\]\s+\[(\d+:\d+:\d+)\]\s+([^\[]+?)\s+\[\*\*\]"
    r"(?:\s+\[Classification:\s*([^\]]*)\])?(?:\s+\[Priority:\s*(\d+)\])?\s+\{(\w+)\}\s+([\d.]+)(?::(\d+))?\s*->\s*([\d.]+)(?::(\d+))?"
)
SYSLOG_5424 = r"(?s)^<(\d{1,3})>(\d+)\s+(\S+)\s+(\S+)\s+(\S+)\s+(\S+)\s+(\S+)\s+(.*)$"
SYSLOG_3164 = r"(?s)^<(\d{1,3})>([A-Z][a-z]{2}\s+\d{1,2}\s+\d{2}:\d{2}:\d{2})\s+(\S+)\s+([^\s:]+)(?::\s*)?(.*)$"
SYSLOG_3164_YEAR = r"(?s)^<(\d{1,3})>([A-Z][a-z]{2}\s+\d{1,2}\s+\d{4}\s+\d{2}:\d{2}:\d{2})\s+(\S+)\s+([^\s:]+)?(?::\s*)?(.*)$"
SYSLOG_PAIR = r"(?U)(\w+)=([\"']?)([^\"'=,\s]+)\2"
